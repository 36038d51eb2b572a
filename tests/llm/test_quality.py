"""Quality measures against plain Python."""

import re

from issuelab.llm import quality

from .awkward import awkward_docs, empty_docs, with_clashes


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_measures(spark):
    texts = ["a b c d e f g h a b c d e f g h", "one two three four five six seven eight nine " * 4 + "x", "x\n\nx\n x\ny"]
    texts += [" ".join("abcdefghij"[(i * i) % 7] for i in range(300)), "# $ %é b | <>", "w " * 40, "\u000b\u000c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.unionByName(awkward_docs(spark).select("doc_id", "text"))
    for r in quality.judge(docs).collect():
        want = plain(r["text"])
        assert {k: r[k] for k in want} == want
        failed = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_labelled_documents(spark, sf):
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("quality", "base_failed", "kept").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    assert all(r["kept"] for r in good)
    assert sum(not r["kept"] for r in rows if r["quality"] == 0) >= 0.9 * sum(r["quality"] == 0 for r in rows)


def test_awkward_tables(spark):
    docs = with_clashes(awkward_docs(spark))
    got = quality.judge(docs)
    assert got.count() == docs.count() and got.where("_words = 'mine'").count() == docs.count()
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.judge(empty_docs(spark)).count() == 0
