"""The stages over the smallest tables; each stage's decision holds in its result."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdfast.llm.queries import vocabulary
from holdfast.session import stage


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, sf), name)
        seen[name] = (before, docs)
        if name != "bpe":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
    before, after = seen["line_dedup"]
    assert before.count() == after.count()
    before, after = seen["jaccard_join"]
    assert after.count() == after.select("doc_id").distinct().count() <= before.count()
    before, after = seen["mixing"]
    assert max(Counter(r["doc_id"] for r in after.select("doc_id").collect()).values()) <= 2
    before, after = seen["bpe"]
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in before.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in after.collect()) == want
    clean = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    good = seen["quality_rules"][0].join(clean, "doc_id").where(F.size(F.split("text", " ")) >= 40)
    kept = good.join(seen["quality_rules"][1].select("doc_id"), "doc_id", "left_semi").count()
    assert kept >= 0.99 * good.count()


def _lines(i, n):
    return [f"line {k} of text {i} with words {i}x{k} and {i}y{k} in it" for k in range(n)]


def test_copies_keep_their_text(spark):
    footer = "all rights of this site are reserved"
    own = [(i, "\n".join([*_lines(i, 6), footer])) for i in range(60)]
    exact = [(100 + i, "\n".join(_lines("copied", 8))) for i in range(30)]
    near = [(200 + i, "\n".join([*_lines("near", 12), f"edition {i}"])) for i in range(30)]
    rows = [(i, t, "en", "site", len(t)) for i, t in own + exact + near]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    clean = stage(corpus_pipeline.line_dedup(spark, docs, ""), "lines")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.jaccard_join(spark, clean, "").collect()}
    assert clean.count() == 120 and not any(footer in t for t in left.values())
    assert all(left[i] == "\n".join(_lines(i, 6)) for i, _ in own)
    assert [left[i] for i, _ in exact if i in left] == [exact[0][1]]
    assert sum("\n".join(_lines("near", 12)) in t for t in left.values()) == 1


def test_odd_rows(spark):
    """Nulls, repeated rows and ids, extra columns with names that the stages use; and no rows at all."""
    text = "\n".join(_lines("odd", 6))
    rows = [(i, "\n".join(_lines(i, 6)), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [rows[3], (None, text, None, None, None), (None, text, None, None, None), (3, text + " once more", "en", "s1", 1), (50, None, "en", "s1", 1),
             (51, "", None, "s2", 1), (52, "word " * 20_000, "en", "s0", 1), (53, " ".join("the word" + "".join(chr(97 + int(d)) for d in str(k)) if k % 9 else "the" for k in range(20_000)), "en", "s0", 1)]
    wide = [(*r, "p", 1, 2.0, "q", "r", [1]) for r in rows]
    docs = spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars int, copies string, size int, "
                                 "target double, unit string, whole_row string, ids array<int>")
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, ""), name)
        if name == "bpe":
            break
        assert docs.dtypes == before.dtypes
        if name == "jaccard_join":
            left = Counter((r["doc_id"], r["text"]) for r in docs.collect())
            assert max(left.values()) == 1 and sum("odd" in t for _, t in left) == 1
            assert {i for i, _ in left} >= set(range(40)) and left.keys() >= {(53, rows[-1][1])}
        if name == "mixing":
            assert docs.where("copies <> 'p' OR size <> 1 OR whole_row <> 'r'").count() == 0 and docs.count() > 0
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in before.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in docs.collect()) == want
    none = before.limit(0)
    for name, step in corpus_pipeline.STAGES:
        none = stage(step(spark, none, ""), name)
        assert none.count() == 0
