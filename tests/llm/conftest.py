"""Small documents with every awkward case, as rows and as a DataFrame with columns that clash with the operators' own."""

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def rows():
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" "] * 8 + ["\n", ". "]) for _ in range(n))

    shared = prose(60)
    texts = [prose(rnd.randint(1, 300)) for _ in range(60)]
    texts += [texts[3], texts[3], texts[4] + " tail", shared + prose(50), prose(20) + shared, shared]
    texts += ["", None, " \t\n", "a", "a b", "Ünï çödé ßß 日本語 テキスト " * 20, "x" * 5000, "the same " * 400, "line one here\n" * 30, "1234 !!! ???", " nbsp em  two   three\r\n\x0bend "]
    texts += [prose(6000), "Hello  World\n\n\nAgain", "tab\tsep\tvalues", "tail space ", " head", "hello <|endoftext|> world", "日本語 テスト <|endoftext|>"]
    out = []
    for i, t in enumerate(texts):
        out.append((i, t, [None, "en", "de"][i % 3], [None, "a", "b", "a", "a", "ü"][i % 6]))
    out.append((5, texts[5], "de", "ü"))  # a repeated row
    out.append((None, "no id here at all", "en", "a"))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    df = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", 2.0, 3) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, size long, fp string, label double, n int")
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
