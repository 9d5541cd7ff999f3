"""URL rules, the filter audit and lexical search against plain brute force, and on nulls, ties, repeats and empty tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import filter_audit, lexical_search, url_rules
from holdfast.llm.queries import PATTERNS, SITES
from holdfast.llm.url_rules import Rule

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

URLS = [None, "", "no scheme", "://", "http://Example.ORG/en/1", "http://a.b.example.org/en/12/x", "https://example.org",
        "https://notexample.org/es/", "https://x.example.org/es/?q", "http://org/", "http://com/FR/", "https://shop.com/fr/a#b",
        "https://shop.com/de/a?utm_source=feed", "https://shop.net/de/a?utm_source=feed", "http://m.shop.net/fr/1", "http://m.shop.net/en/1",
        "https://www.shop.net/de/x#top", "https://blog.shop.net/en/9.html", "https://blog.shop.net/en/9.htm", "https://x.net/LOGIN",
        "https://x.net/login_form", "https://x.net/a?page=2&ref=q", "https://x.net/a?mypage=2&ref=q", "a://b://example.org/en/1",
        "https://x.net/robots.txt", "https://x.net/wp-login.php?next=/robots.txt", "http://münchen.org/straße", "http://x.org/\n/y",
        "https://x.net/" + "login/" * 20_000, "https://user@x.com:80/fr/", "https://xcom/de/", "https://x.com./de/"]


def _plain_url(url, sites, patterns):
    text = (url or "").translate(ASCII)
    parts = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (parts[1].translate(ASCII), parts[2]) if parts else ("", "")
    fits = []
    for r in sites:
        h, _, p = r.text.partition("/")
        if (host == h.translate(ASCII) or host.endswith("." + h.translate(ASCII))) and path.startswith("/" + p):
            fits.append((len(r.text), len(h), r.verdict == "block", r))
    if fits:
        return host, path, max(fits, key=lambda f: f[:3])[3].text, None, max(fits, key=lambda f: f[:3])[3].verdict
    for r in patterns:
        p = r.text.translate(ASCII)
        start, end = p.startswith("|"), p.endswith("|")
        body = p[start:len(p) - end]
        regex = "".join({"*": r"[\s\S]*", "^": r"(?:[^0-9a-z_.%-]|\Z)"}.get(c, re.escape(c)) for c in body)
        if re.search(("^" if start else "") + regex + (r"\Z" if end else ""), text):
            fits.append((r.verdict == "allow", len(r.text), r.verdict == "block", r.text, r.verdict))
    return host, path, None, *(max(fits)[3:] if fits else (None, "allow"))


def test_url_rules_equal_brute_force(spark):
    rnd = random.Random(4)
    made = ["".join(rnd.choices(["http://", "m.", "blog.", "example", ".org", ".net", ".com", "/", "en/", "es/", "1", "login", "?", "&ref=",
                                 "page=", "#top", ".html", "A", "x"], k=rnd.randint(2, 12))) for _ in range(400)]
    rows = [(i, u, "p", "q", "r") for i, u in enumerate([*URLS, *made])] + [(None, None, "p", "q", "r")] * 3 + [(7, URLS[4], "p", "q", "r")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, token string, judged string, row string").repartition(3)
    got = url_rules.judge_urls(df, ["page_id", "token", "row"], [*SITES, *PATTERNS, Rule("*", "allow"), Rule("", "allow")])
    assert got.columns == ["page_id", "token", "row", "judged"]
    found = Counter((r["page_id"], tuple(r["judged"][c] for c in ("host", "path", "rule", "pattern", "verdict"))) for r in got.collect())
    patterns = [*PATTERNS, Rule("*", "allow"), Rule("", "allow")]
    # The pattern "*" lets everything pass that nothing else allows.
    assert found == Counter((r[0], _plain_url(r[1], SITES, patterns)) for r in rows)
    plain = url_rules.judge_urls(df, ["page_id"], [*SITES, *PATTERNS]).collect()
    assert Counter((r["page_id"], tuple(r["judged"][c] for c in ("host", "path", "rule", "pattern", "verdict"))) for r in plain) == Counter(
        (r[0], _plain_url(r[1], SITES, PATTERNS)) for r in rows)


def test_url_rules_without_rows_or_rules(spark):
    df = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert url_rules.judge_urls(df.limit(0), ["page_id"], SITES).count() == 0
    assert url_rules.judge_urls(df, ["page_id"], [], otherwise="block").first()["judged"]["verdict"] == "block"
    # Equally long sites that contradict each other block.
    assert url_rules.judge_urls(df, ["page_id"], [Rule("org/", "allow", True), Rule("org/", "block", True)]).first()["judged"]["verdict"] == "block"


def test_rules_lie_under_their_rarest_bounded_token(spark):
    rules = [Rule("://blog.*/en/*.html|", "block"), Rule("example.org/en/1", "block", True), Rule("/lo*in", "block"), Rule("half", "block")]
    urls = spark.createDataFrame([(f"http://blog.example.org/en/{i}",) for i in range(9)] + [("http://a.b/c.html",)] * 4, "url string")
    table = spark.createDataFrame([(r.text, r.verdict, r.site) for r in rules], "text string, verdict string, site boolean")
    got = {r["weight"]["text"]: r["token"] for r in url_rules.indexed(table, urls).collect()}
    # "1" and "half" may go on in the URL, "lo" and "in" too: no tokens.
    assert got == {"://blog.*/en/*.html|": "html", "example.org/en/1": "en", "/lo*in": "", "half": ""}


def test_packed_counters_equal_brute_force(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice([None, "", "a", "b"]), *(rnd.choice([True, False, False, None]) for _ in range(4)), rnd.random() < .3)
            for _ in range(300)]
    df = spark.createDataFrame(rows, "part string, p boolean, q boolean, r boolean, n boolean, mask boolean")
    got = filter_audit.audit(df, {"P": df["p"], "Q": df["q"], "R": df["r"]}, df["part"], {"lost": df["mask"]}).collect()
    want = {}
    for part in ("", "a", "b"):
        mine = [r for r in rows if (r[0] or "") == part]
        removed_by = Counter()
        for order in permutations("PQR"):
            left = mine
            for step, f in enumerate(order, 1):
                fails = lambda r, f=f: r[1 + "PQR".index(f)] is True
                gone = [r for r in left if fails(r)]
                rest = [r for r in left if not fails(r)]
                removed_by[f] += len(gone)
                want[part, "".join(order), step] = (
                    len(rest), len(gone), sum(map(fails, mine)) - len(gone),
                    sum(fails(r) and sum(x is True for x in r[1:4]) == 1 for r in mine), sum(r[5] for r in gone), f)
                left = rest
        want |= {k: (*v[:5], removed_by[v[5]]) for k, v in want.items() if k[0] == part}
    assert {(r["part"], r["filter_order"], r["step"]): (
        r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["lost"], r["shapley"]) for r in got} == want
    assert filter_audit.audit(df.limit(0), {"P": df["p"]}, df["part"]).count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit(df, {c: df["p"] for c in "ABCDEFG"}, df["part"])


def test_fields_do_not_run_over():
    table, k = filter_audit.packed("ABCDE"), 5
    fields = len(filter_audit.orders("ABCDE")) * k
    n = (1 << 63) // 32
    total = sum((n - m) * table["kept"][m] for m in range(32))
    kept = filter_audit.unpacked(total, fields)
    assert fields == 600 and kept.min() == n
    # After the first step A the masks without A are left.
    assert kept[0] == sum(n - m for m in range(32) if not m & 1)


def test_audit_of_documents(spark):
    long = " ".join(f"w{i}" for i in range(250))
    rows = [(1, long, "s", 0, "x"), (2, long, "s", 0, "x"), (2, long, None, 0, "x"), (None, long, "s", 0, "x"), (None, None, "", 0, "x"),
            (5, "", "t", 0, "x"), (6, None, "t", 0, "x"), (1, long, "t", 0, "x"), (7, "A b # " * 200_000, "t", 0, "x"), (8, "ÄÖ " * 250, "t", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mask int, part string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (2, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit_documents(docs, labels).collect()}
    assert len(got) == 3 * 600
    first = got["s", "EABCD", 1]
    assert (first["kept"], first["removed"], first["good_lost"], first["toxic_lost"]) == (2, 1, 0, 1)
    # Rows without an id pass E, and so do both rows with the smallest id.
    assert got["", "EABCD", 1]["removed"] == 1 and got["t", "EABCD", 1]["removed"] == 1
    assert got["", "ABCDE", 1]["removed"] == 1 and got["t", "ABCDE", 1]["removed"] == 2
    assert got["t", "BACDE", 1]["removed"] == 2 and got["t", "CABDE", 1]["removed"] == 1 and got["t", "DABCE", 1]["removed"] == 1
    assert got["t", "DBCAE", 2]["redundant"] == 1 and got["s", "ABCDE", 5]["unique_fails"] == 1
    assert filter_audit.audit_documents(docs.limit(0), labels).count() == 0
    assert filter_audit.audit_documents(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def _plain_search(docs, items, k):
    docs = [(d, Counter(TERM.findall((t or "").translate(ASCII)))) for d, t in docs]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall((t or "").translate(ASCII)))
    out = set()
    for i, terms in wanted.items():
        scores = []
        for d, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            scores += [(-s, d is None, d or 0, d)] if s > 0 else []
        out |= {(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])}
    return out


def test_lexical_search_equals_brute_force(spark):
    rnd = random.Random(2)
    vocab = [f"t{i}" for i in range(80)] + ["Äpfel", "你好", "naïve", "CASE"]
    docs = [(i, " ".join(rnd.choices(vocab, weights=[100 // (k + 1) + 1 for k in range(len(vocab))], k=rnd.randint(1, 60)))) for i in range(500)]
    docs += [(500, None), (501, ""), (502, " .,;\n"), (None, "t70 T71 case-CASE"), (3, docs[3][1]), (3, docs[3][1]), (504, "t5 " * 30_000),
             (505, docs[9][1]), (-4, docs[9][1])]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(1, 12)))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "unknown"), (33, docs[9][1]), (33, "t70"), (None, "t71 t5"), (34, "T5, t5; t5!")]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, query int").repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    want = _plain_search(docs, items, 10)
    for at_once in (1024, 7):
        got = [tuple(r) for r in lexical_search.lexical_search(d, q, 10, queries_at_once=at_once).collect()]
        assert Counter(got) == Counter(want)
    assert lexical_search.lexical_search(d.limit(0), q).count() == lexical_search.lexical_search(d, q.limit(0)).count() == 0


def test_bounds_hold_and_save_work():
    """A bound is never below the score, and after the first blocks few documents are scored."""
    rnd = random.Random(6)
    vocab = [f"w{i}" for i in range(3000)]
    weights = [1 / (k + 1) for k in range(len(vocab))]
    texts = [" ".join(rnd.choices(vocab, weights, k=120)) for _ in range(6000)]
    items = [" ".join(rnd.choices(vocab, weights, k=25)) for _ in range(8)]
    counted = list(lexical_search._counted(pa.array(texts)))
    n_docs, n_terms = len(texts), sum(int(c[1].sum()) for c in counted)
    df = Counter(np.concatenate([c[3] for c in counted]).tolist())
    rows = [(q, c) for _, _, doc, codes, _ in lexical_search._counted(pa.array(items)) for q, c in zip(doc.tolist(), codes.tolist())]
    batch = lexical_search.Batch(np.array([q for q, _ in rows], np.int32), np.array([c for _, c in rows], np.uint64),
                                 np.array([lexical_search.weight(df[c], n_docs) for _, c in rows], np.int64))
    narrow = [lexical_search.Search(batch, n_docs, n_terms, 10, width) for width in (8, 1024)]
    for s in narrow:
        s.read(np.arange(n_docs), np.zeros(n_docs, bool), pa.array(texts))
    # Eight coordinates bound badly but give the same answer.
    assert all(np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]) for a, b in zip(narrow[0].best, narrow[1].best))
    assert narrow[1].scored < 0.35 * len(items) * n_docs < narrow[0].scored
