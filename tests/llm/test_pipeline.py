import random

from pyspark.sql import functions as F

import corpus_pipeline


def corpus(spark, n=240):
    rnd = random.Random(12)
    syllables = {"en": "th er on an re he in ed nd ha at en es of or".split(), "de": "ch ei ung sch ver ß ü er en ge".split()}

    def words(lang, k):
        return ["".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(k)]

    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "de"])
        rows.append((i, "\n".join(" ".join(words(lang, 30)) for _ in range(4)), lang, f"s{i % 3}"))
    boiler = " ".join(words("en", 12))
    for i in range(0, 40):
        rows[i] = (i, rows[i][1] + "\n" + boiler, *rows[i][2:])
    rows += [(1000 + i, rows[50 + i][1], rows[50 + i][2], "s0") for i in range(10)]  # exact copies
    for i in range(10):  # near copies
        w = rows[80 + i][1].split(" ")
        w[50] = "changed"
        rows.append((1100 + i, " ".join(w), rows[80 + i][2], "s1"))
    rows += [(2000, None, "en", "s0"), (2001, "", "en", "s0"), (2002, "これは日本語です" * 30, None, None)]
    df = spark.createDataFrame([(*r, len(r[1] or ""), "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, label string")
    return rows, df.repartition(3), boiler


def test_stages_act_on_what_they_are_for(spark):
    rows, df, boiler = corpus(spark)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "mix_sources", "packing"]
    kept = stages["language_id"](spark, df, "")
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {r[0] for r in rows} - ids == {2000, 2001, 2002}
    lined = stages["line_dedup"](spark, df, "")
    assert lined.columns == df.columns and lined.count() == df.count()
    holders = [r["doc_id"] for r in lined.collect() if boiler in (r["text"] or "")]
    assert holders == [0]
    assert all(r["n_chars"] == len(r["text"]) for r in lined.where("text is not null").collect())
    near = stages["near_dedup"](spark, df, "")
    left = {r["doc_id"] for r in near.collect()}
    assert near.columns == df.columns and not left & {*range(1000, 1010), *range(1100, 1110)}
    assert left >= set(range(240))
    mixed = stages["mix_sources"](spark, df, "")
    assert mixed.columns == df.columns and mixed.count() > df.count()
    packed = stages["packing"](spark, df, "")
    assert packed.selectExpr("sum(length)").first()[0] == sum(r["doc_tokens"] for r in packed.select("doc_id", "doc_tokens").distinct().collect())


def test_every_stage_takes_an_empty_table(spark):
    _, df, _ = corpus(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), "").count() == 0


def test_stages_take_repeated_rows_and_clashing_columns(spark):
    _, df, _ = corpus(spark)
    names = "bits copies below row did line leaf masked fp limbs lang_pred rejected score _row _lines".split()
    docs = df.union(df.where("doc_id < 5")).select("*", *[F.col("doc_id").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[n] == r["doc_id"] for r in got for n in names), name


def test_run_over_a_whole_table(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.where("length <= 0 or offset < 0").count() == 0


def test_every_stage_starts_from_a_collected_heap(spark):
    _, df, _ = corpus(spark)
    docs = df.limit(20)

    def full() -> int:
        beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    for name, stage in corpus_pipeline.STAGES:
        before = full()
        stage(spark, docs, "")
        assert full() > before, name
