"""Each stage of the corpus pipeline against its own input, by other means than its operator's."""

from array import array

import duckdb
import public_tokenizers
import sentencepiece
from test_simhash import brute_components, brute_print

import corpus_pipeline
from hexaccess.llm import lines, mixing, quality
from hexaccess.llm.common import read_table, stage_table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_stages(spark):
    docs, seen = read_table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage_table(stage(spark, docs, SF), "test-stage")
        seen.append((name, docs, out))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == COLUMNS
        docs = out
    assert [n for n, _, _ in seen] == ["quality classifier", "line dedup", "simhash near-dedup", "source mix", "sentencepiece"]

    _, before, after = seen[0]
    model = quality.train(before, read_table(spark, SF, "labels"))
    assert rows(after) == sorted([tuple(r[c] for c in COLUMNS) for r in before.collect() if model.score(r["text"]) >= 0.7], key=str)
    assert 0.7 * before.count() < after.count() < before.count()

    _, before, after = seen[1]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    want = {i: text for i, _, _, text in con.execute(lines.OP3_SQL).fetchall()}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    _, before, after = seen[2]
    prints = {r["doc_id"]: brute_print(r["text"]) for r in before.collect()}
    firsts = set(brute_components(prints).values())
    assert {r["doc_id"] for r in after.collect()} == firsts and after.count() == len(firsts)

    _, before, after = seen[3]
    con.execute("DROP VIEW IF EXISTS documents")
    con.register("documents", before.toPandas())
    copies = {i: taken // size if size else None for i, size, _, _, taken in con.execute(mixing.OP2_SQL).fetchall()}
    got = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert all(got.get(i, 0) == c for i, c in copies.items() if c is not None)

    _, before, after = seen[4]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert after.count() == before.count()
    assert all(list(r["piece_ids"]) == library.encode(r["text"]) and r["n_ids"] == len(r["piece_ids"]) for r in after.collect())


def test_run_is_the_stages_and_reruns_agree(spark):
    a, b = corpus_pipeline.run(spark, SF), corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], r["text"], tuple(array("i", r["piece_ids"]))) for r in df.collect())
    assert a.columns == [*COLUMNS, "piece_ids", "n_ids"] and key(a) == key(b) and a.count() > 0


def test_empty_tables(spark, monkeypatch, tmp_path):
    for name in ("documents", "labels"):
        read_table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows(spark, tmp_path):
    from fixtures import docs
    d = docs(spark, clash=True)
    d.unionByName(d.limit(4)).unionByName(d.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", *d.columns[1:])).write.parquet(str(tmp_path / "documents.parquet"))
    read_table(spark, SF, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(d.columns) <= set(out.columns) and out.count() > 0
