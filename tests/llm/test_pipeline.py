import re

import corpus_pipeline
from daybook.llm import pieces, simhash
from daybook.llm.shared import scratch_path
from llm.test_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "pieces"]
    before = {r["doc_id"]: r for r in docs.collect()}
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if name != "pieces":
            assert docs.columns == columns
        ids = [r["doc_id"] for r in rows]
        assert set(ids) <= set(before)
        kept[name] = rows
        if name == "toxicity":
            swear = re.compile(r"\b(idiot|moron|stupid|loser|scum)\b", re.I)
            assert sum(bool(swear.search(r["text"])) for r in rows) < sum(bool(swear.search(r["text"])) for r in before.values())
        if name == "line_dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] != before[r["doc_id"]]["text"])
        if name == "simhash_dedup":
            prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in kept["line_dedup"]}
            assert sorted(ids) == sorted({*brute_groups(prints).values()})
    text = {r["doc_id"]: r["text"] for r in kept["simhash_dedup"]}
    tokens = pieces.Pieces.load()
    assert len(kept["pieces"]) == len(kept["mixing"])
    for r in kept["pieces"]:
        assert r["round_trip"] and tokens.decode(r["token_ids"]) == text[r["doc_id"]]


def test_odd_and_empty_documents(spark, odd_documents, no_documents):
    odd = odd_documents
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, SF)
    assert odd.count() >= 1
    empty = no_documents
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_copies_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, text, "en", "s") for i in range(30)] + [(99, text + " tail words differ", "en", "s")], "doc_id long, text string, lang string, source string")
    found = simhash.near_duplicates(docs)
    assert [r["doc_id"] for r in simhash.keep_one(docs.where("doc_id < 50"), found.where("id < 50")).collect()] == [0]


def test_scratch_tables_of_a_scope_go(spark, tmp_path):
    from daybook.llm.shared import materialise, scratch_path, scratch_scope

    kept = scratch_path(spark, "kept")
    with scratch_scope(spark):
        inside = materialise(spark.range(5), "inside")
        inside.write.parquet(kept)
        folder = inside.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.parquet(kept).count() == 5
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
