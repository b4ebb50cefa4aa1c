import corpus_pipeline


def stage(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    return {r["doc_id"]: r["text"].split("\n") for r in corpus_pipeline.line_dedup_stage(spark, df, "").collect()}


def test_lines_of_two_documents_and_of_any_script(spark):
    shared = ["all rights of this text are reserved", "本サイトの内容を無断で転載することを禁じます", "ห้ามทำซ้ำหรือดัดแปลงเนื้อหานี้", "one\ttwo\tthree\tfour\tfive\tsix", "un\xa0deux\xa0trois\xa0quatre\xa0cinq"]
    own = ["a line that only the first has", "which words stand here is the second's own affair"]
    got = stage(spark, ["\n".join([own[0], *shared, "短い行"]), "\n".join([*shared, own[1], "短い行"])])
    assert got == {0: [own[0], *shared, "短い行"], 1: [own[1], "短い行"]}


def test_two_documents_with_lines_half_alike_keep_both(spark):
    texts = ["we saw the x old red house near y hill", "we saw the a new big tree over b lake"]
    assert stage(spark, texts) == {i: [t] for i, t in enumerate(texts)}


def test_rows_of_numbers_recur_only_as_they_are(spark):
    texts = [f"12 7 3.5 40 {i}\n1 2 3 4 5\nx1 y{i} z2 alpha beta\nuser ann logged in on day {i}" for i in range(4)]
    got = stage(spark, texts)
    assert got[0] == texts[0].split("\n")
    assert all(got[i] == [f"12 7 3.5 40 {i}", f"x1 y{i} z2 alpha beta"] for i in range(1, 4))
