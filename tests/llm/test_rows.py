"""Token files, URL filter, license scan and language ID against brute force, round trips and held-out accuracy."""

import json
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from proplens.llm import language_id, license_scan, token_output, url_filter
from proplens.llm.common import scratch_uri
from proplens.llm.queries import RULES

PATH = public_tokenizers.path("byte_bpe_50k.json")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_tokens_round_trip(spark, frame, request, source, tokenizer):
    rows = request.getfixturevalue(source) + [(500, "<|endoftext|> don't\r\n  stop\n\n", None, None), (501, "a\nb c", None, None)]
    uri = scratch_uri(spark, "test-tokens")
    got = token_output.token_output(frame(rows), PATH, uri=uri).collect()
    ids = {(r[0], r[1]): tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (str(r[0]), len(ids[r[0], r[1]]), crc(ids[r[0], r[1]])) for r in rows)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    known = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert known == sorted(known)
    fs, path = token_output._store(uri)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        manifest = json.loads(f.read())
    flat = np.concatenate([np.fromfile(f"{path}/{p['part']}.bin", manifest["dtype"]) for p in manifest["parts"]])
    assert len(flat) == at == manifest["tokens"]
    one = next(r for r in got if r["doc_id"] == 501)
    assert flat[one["start"]:one["start"] + one["n_tokens"]].tolist() == ids[501, "a\nb c"]


def test_pieces_encode_like_whole_texts(tokenizer):
    import random

    import pyarrow as pa
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \n\t\ra1.!'éB²\xa0\x1c\x85") for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["<|endoftext|> a", "a <|endoftext|>b\t <|endoftext|>", "<|endoftext", "x\0<|endoftext|>"]
    assert tokenizer.encode(texts[3000], add_special_tokens=False).ids == [50256, 257]
    ids, n = token_output.PieceEncoder(PATH).texts(pa.array(texts))
    parts = np.split(ids, np.cumsum(n)[:-1])
    for t, p, e in zip(texts, parts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert p.tolist() == e.ids, repr(t)


def judge(url, listed):
    """(host, path, rule, verdict) by plain string work."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = host.translate(UP)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.verdict
    return host, path, None, "block" if listed else "allow"


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "http://A.net/x", "http://a.net", "HTTP://EXAMPLE.net/en/1", "x://net/?q",
            "http://example.net/enx", "http://www.example.com/de/1#t", "http://example.com/de", "http://b.org/fr/1?x=http://n",
            "http://notorg/fr/", "http://bad.example.com:80/p/?utm_source=a&b=2&a=1#z", "https://bad.example.com/p?a=1&b=2",
            "https://bad.example.com/p?a=1", "http://bad.example.com/p/index.html?a=1&b=2", "http://ÉA.com/x\ny://z/?q"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(3, None, "x", "y"), (None, urls[4], None, None)],
                               "page_id long, url string, canonical string, block string")
    listed = spark.createDataFrame([("bad.example.com/p?a=1&b=2",), ("bad.example.com/p?a=1&b=2",), (None,), ("q.com/",)],
                                   "canonical string")
    for blocks in (1, url_filter.MAX_BLOCKS):  # one block lets nearly all through; the join decides
        got = url_filter.filter_urls(df, listed, RULES, max_blocks=blocks).collect()
        assert len(got) == len(urls) + 2
        for r in got:
            url = urls[4] if r["page_id"] is None else None if r["listed"] is None else urls[r["page_id"]]
            if r["page_id"] == 3 and r["host"] == "":
                continue
            hit = r["page_id"] in (13, 14, 16)
            assert r["listed"] == hit and (r["host"], r["path"], r["rule"], r["verdict"]) == judge(url, hit)
    none = listed.limit(0)
    assert url_filter.filter_urls(df, none, RULES).filter("listed").count() == 0
    assert url_filter.filter_urls(df.limit(0), listed, RULES).count() == 0


def test_listed_pages(spark, monkeypatch):
    """A list by what pages say: of two URLs of one host one is listed; against plain string work."""
    from html.parser import HTMLParser

    class Seen(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.out, self.off = [], 0
        def handle_starttag(self, tag, attrs): self.off += tag in ("script", "style"); self.out.append(" ")
        def handle_endtag(self, tag): self.off -= tag in ("script", "style"); self.out.append(" ")
        def handle_comment(self, data): self.out.append(" ")
        def handle_data(self, data): self.out.append("" if self.off else data)

    def words(html):
        seen = Seen()
        seen.feed(html or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(seen.out).translate(UP))

    good = "<p>" + " ".join(f"Word{i}" for i in range(60)) + "</p><script>var x = 1 < 2;</script>"
    rows = [(3, "http://a.com/good", good), (4, "http://a.com/junk?utm_source=x", "<b>" + "Buy now <i>cheap</i> " * 40 + "</b>"),
            (5, "http://b.com/same", good.replace("<p>", "<!-- x > y --><div>")), (6, "https://a.com/good/", good.upper()),
            (7, "http://c.com/short", "spam " * 49), (8, None, "spam " * 90), (9, "http://c.com/null", None),
            (None, "no host", good), (10, "http://d.com/é", "É é <style>p{}</style>" * 30), (10, "http://d.com/é", "Éé " * 60)]
    rows += [(100 + i, f"http://copies.com/{i}", good.replace("Word3 ", "Other ")) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("words", "n", "canonical", "said", "id")}).repartition(4)
    got = {(r["canonical"], r["reason"]) for r in url_filter.listed_pages(df).collect()}
    want, first = set(), {}
    for i, url, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = words(html)
        if not url or "://" not in url or len(w) < 50:
            continue
        at = url.split("://")[1].split("?")[0].rstrip("/")
        if len(set(w)) < len(w) / 4:
            want.add((at, "junk"))
        if first.setdefault(tuple(w), at) != at:
            want.add((at, "copy"))
    assert got == want and ("a.com/junk", "junk") in got and ("b.com/same", "copy") in got and len(got) == 32
    assert not {u for u, _ in got} & {"a.com/good", "copies.com/0", "c.com/short"}
    assert url_filter.listed_pages(df.limit(0)).count() == 0
    # A list beyond the broadcast bound: the same rows by the shuffled filter.
    listed = url_filter.listed_pages(df)
    wide = url_filter.filter_urls(df, listed, [], max_blocks=0)
    assert wide.exceptAll(url_filter.filter_urls(df, listed, [])).count() == 0 and wide.filter("listed").count() == 33


def test_template_markup():
    a = license_scan.Automaton("<<opt>>the<<end>> red <<any:2>> fox <<opt>>runs <<opt>>very<<end>> fast<<end>>")
    say = lambda t, i=0: a.longest(t.encode().split(), i)
    assert say("the red fox") == 3 and say("red big old fox") == 4 and say("red big old mad fox") is None
    assert say("red fox runs fast now") == 4 and say("red fox runs very fast") == 5 and say("red fox runs") == 2
    assert say("the the red fox") is None and say("the red") is None and say("red fox fox") == 3
    for bad in ("<<end>> x", "<<opt>> x", "<<opt>>x<<end>>", "<<any:2>> x"):
        with pytest.raises(ValueError):
            license_scan.Automaton(bad)


def said(wording, options):
    """A text of the wording, with or without its optional words; replaceable words are as many as allowed, or none."""
    while "<<opt>>" in wording:
        wording = re.sub(r"<<opt>>((?:(?!<<opt>>|<<end>>).)*)<<end>>", r" \1 " if options else " ", wording)
    return re.sub(r"<<any:(\d+)>>", lambda m: "zzz " * int(m[1]) if options else "", wording).split()


def as_pattern(wording):
    """The wording as a regular expression over words that each end in one space."""
    out = []
    for mark, word in re.findall(r"<<(opt|end|any:\d+)>>|([^<\s]+)", wording):
        out.append("(?:" if mark == "opt" else ")?" if mark == "end" else rf"(?:\S+ ){{0,{mark[4:]}}}" if mark else word + " ")
    return re.compile("".join(out))


@pytest.mark.parametrize("label,wording", license_scan.TEMPLATES)
def test_templates_are_whole(label, wording):
    """Every mandatory word taken out or replaced, optional words changed, against a regular expression."""
    a, pattern = license_scan.Automaton(wording), as_pattern(wording)
    bare, full = said(wording, False), said(wording, True)
    taken = lambda w: a.longest([x.encode() for x in w], 0) if w and w[0].encode() in a.starts else None
    assert taken(bare) == len(bare) and taken(full) == len(full) and taken(["x", *full]) is None
    texts = [w[:i] + c + w[i + 1:] for w in (bare, full) for i in range(len(w)) for c in ([], ["qqq"], [w[i], "qqq"])]
    for w in texts:
        m = pattern.match("".join(x + " " for x in w))
        # The expression takes the first way, the automaton the longest: an end of the one is no end less than the other.
        assert (taken(w) is None) == (m is None), w
        assert m is None or taken(w) >= len(m[0].split())
    assert sum(taken(bare[:i] + bare[i + 1:]) is None for i in range(len(bare))) >= len(bare) - 3


def test_changed_licenses_are_not_accepted(frame):
    whole = " ".join(said(license_scan.MIT, True))
    texts = [whole, whole.replace("merchantability", ""), whole.replace("without limitation", "with limitation"),
             f"{license_scan.BSD_CONDITIONS} {license_scan.BSD_THIRD} {license_scan.BSD_DISCLAIMER}",
             f"{license_scan.BSD_CONDITIONS} {license_scan.BSD_DISCLAIMER}", license_scan.gnu_notice("affero ", "3"),
             "Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."]
    texts[3:6] = [" ".join(said(t, True)) for t in texts[3:6]]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(frame([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    assert [got[i] for i in range(8)] == ["mit", "", "", "bsd-3-clause", "bsd-2-clause", "agpl-3.0,gpl", "cc-by-sa-4.0", "cc-by-4.0"]


PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@pytest.mark.parametrize("source", ["edge_docs", "sf_docs"])
def test_license_scan(frame, request, source):
    lines = ["Released under the MIT License.", "MIT LICENSE, mit license; MIT-License Apache License mit licenses",
             "This work is licensed under the GNU General Public License, version 3.", "é MIT\u00a0license",
             "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.", "gnu general public license " * 500]
    rows = request.getfixturevalue(source) + [(700 + i, t, None, None) for i, t in enumerate(lines)]
    got = license_scan.scan_licenses(frame(rows)).collect()
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = []
    for i, t, *_ in rows:
        w = pattern.findall((t or "").translate(UP))
        at = [(j, label) for p, label in PHRASES for j in range(len(w)) if w[j:j + len(p.split())] == p.split()]
        want.append((str(i), len(w), len(at), str(min((j for j, _ in at), default=None)),
                     str(max((j for j, _ in at), default=None)), ",".join(sorted({x for _, x in at}))))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_base"], str(r["first_word"]), str(r["last_word"]),
                   r["base_labels"]) for r in got) == sorted(want)
    by = {r["doc_id"]: r for r in got}
    assert [by[700 + i]["labels"] for i in (0, 2, 4, 5)] == ["mit", "gpl,gpl-3.0", "cc-by-nc-4.0", "apache,apache-2.0"]
    assert by[700]["score"] == 1.0 and by[1]["score"] == 0.0
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
               for r in got)
    assert license_scan.scan_licenses(frame([])).count() == 0


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    model = language_id.BiGRU(3, 4, 0)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, y = rng.integers(0, 256, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5)
    _, g = model.gradients(x, y)
    for k, w in model.weights.items():
        at = (int(x[0, 2]), 3) if k in ("fx", "bx") else tuple(0 for _ in w.shape)
        old, step = w[at], 1e-3
        w[at] = old + step
        up, _ = model.gradients(x, y)
        w[at] = old - step
        down, _ = model.gradients(x, y)
        w[at] = old
        assert g[k][at] == pytest.approx((up - down) / (2 * step), abs=2e-4), k


def test_language_id(spark, frame, sf_docs, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, classes = language_id.fit(docs)
    assert classes == ["de", "en", "es", "fr"]
    rows = language_id.identify(docs, model, classes, extra=("lang",)).collect()
    held = [r for r in rows if r["held_out"]]
    assert [r["held_out"] for r in rows] == [zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    got = language_id.identify(frame(edge_docs), model, classes).collect()
    assert len(got) == len(edge_docs)
    und = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 14, None} and all((r["score"] == 0) == (r["lang_pred"] == "und") for r in got)
    # By itself, in other company and in other pieces of the table a text gets the same label.
    labeller = language_id.Labeller(model, len(classes))
    import pyarrow as pa
    t = docs.first()["text"]
    probs = np.concatenate([model.log_probs(np.frombuffer(p, np.uint8)[None])[0] for p in language_id.pieces(t)])
    p = np.exp(probs.mean(0)) / np.exp(probs.mean(0)).sum()
    assert labeller.documents(pa.array([t]))[0] == pytest.approx(p, abs=1e-4)


def test_language_id_without_labels(frame):
    model, classes = language_id.fit(frame([(1, "some text", None, "a"), (2, None, "en", "a")]))
    assert model is None and classes == []
    got = language_id.identify(frame([(1, "some text", None, "a")]), model, classes).collect()
    assert got[0]["lang_pred"] == "und"
    assert language_id.identify(frame([]), model, classes).count() == 0
