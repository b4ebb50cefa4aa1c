import random

from quillfold.llm import langid


def test_a_language_of_few_texts_keeps_its_model_beside_a_flat_one(spark):
    rnd = random.Random(3)
    flat = [("ja", "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(600))) for _ in range(900)]
    few = [("zz", "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60))) for _ in range(12)]
    model = langid.fit(spark.createDataFrame(flat + few, "lang string, text string").repartition(3))
    assert model.languages == ["ja", "zz"]
