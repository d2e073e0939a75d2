"""The corpus pipeline: what each stage keeps of its own input."""

import corpus_pipeline

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "exact_dedup", "simhash", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF).cache()
        assert kept.columns == docs.columns
        ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert len(ids) == kept.count() and ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        good = {r["doc_id"] for r in marks.filter("quality = 1 and toxic = 0").join(docs, "doc_id").collect()}
        if name in ("toxicity", "quality"):
            assert len(good & ids) > 0.98 * len(good)
        docs = kept
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids


def test_stages_on_empty_and_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(3).unionByName(docs.limit(1)).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (10**12, "", "en", "s", 0)], docs.schema)
    )
    for table in (docs.limit(0), odd):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, SF).count() <= max(1, table.count()) or name == "packing"


def test_near_copies_keep_one_document_of_each_group(spark):
    far = ["the river bends slowly towards a wide grey sea", "parliament votes on seven bills before noon today"]
    near = "one two three four five six seven eight nine ten"
    rows = [
        (None, far[0]), (None, far[1]),
        (5, "bakers knead cold dough long before sunrise comes"), (5, "engines need clean oil and a patient driver"),
        # Equal but for white space and case, so linked: the smallest id stays, a null id never before another.
        (9, near), (7, near.upper()), (7, near.upper()), (None, near + " "),
        # The document of a linked group shares its id with one of another.
        (2, "glaciers carve deep valleys over many thousand years"), (3, "Glaciers carve deep valleys over many thousand years"),
        (3, "a violin is tuned in fifths from low to high"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, table, SF)
    want = [*rows[:4], (7, near.upper()), rows[8], rows[10]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
