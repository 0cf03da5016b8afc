"""The corpus pipeline stage by stage on a small table with planted cases, and the registration of all queries."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from proplens.llm.common import written
from tests.llm.conftest import SF, add_clashes
from tests.llm.test_near_and_spans import groups_by_pairs, hits_by_windows, simhash_by_bits


def test_stages(spark, sf_docs):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sf_docs + [(1000, None, "en", "a"), (1001, "12 34", "en", "a"), (1002, sf_docs[0][1], "en", "b"),
                      (1003, "we quote: " + bench[0][1], "en", None)]
    docs = add_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        seen[name] = docs
        if name != "tokens":
            assert docs.columns == before.columns
    ids = {n: sorted(r["doc_id"] for r in d.select("doc_id").collect()) for n, d in seen.items()}
    assert set(r[0] for r in rows) - set(ids["language"]) == {1000, 1001}
    left = [r for r in rows if r[0] in set(ids["language"])]
    group = groups_by_pairs([simhash_by_bits(r[1], 3) for r in left], 2)
    first = sorted(min(r[0] for r, h in zip(left, group) if h == g) for g in set(group))
    assert ids["near_copies"] == first and 1002 not in first
    text = {r[0]: r[1] for r in rows}
    assert ids["benchmark_leaks"] == [i for i in first if not hits_by_windows(text[i], bench, 10)[1]]
    assert 1003 not in ids["benchmark_leaks"]
    assert set(ids["mix"]) <= set(ids["benchmark_leaks"]) and max(map(ids["mix"].count, ids["mix"])) <= 2
    assert ids["tokens"] == ids["mix"]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = {i: len(t.encode(text[i], add_special_tokens=False).ids) + 1 for i in set(ids["mix"])}
    assert all(r["n_tokens"] == n[r["doc_id"]] for r in seen["tokens"].collect())


def test_registered(spark):
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
