"""URL filter: rules and models against plain Python, odd tables."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import CLASHING, rows_of, with_clashes

from tallyward.llm import urls
from tallyward.llm.textblocks import Block


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:at], rest[at:]
    end = min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def plain_rule(host, path):
    best = None
    for verdict, rule in urls.RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best


ODD = [None, "", "no url", "HTTP://Www.Example.COM/en/x?y", "http://a.net/ES/", "http://b.net/es/", "x://http://É.Org#a", "http://com/",
       "ftp://xcom/", "http://a.com", "http://m.example.com/en/" + "z" * 50_000, "http://www.example.com/en/1", "http://a.www.example.com/en/",
       "http://net/es/", "http://x.example.com/en", "http://a\nb.com/\n?", "://", "http://İ.com/", "http://m.example.com/en/1"]


def test_rules_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(1000 + i, u) for i, u in enumerate(ODD)] + [(None, None), (5000, "http://a.com/"), (5000, "http://a.com/")],
                                "page_id long, url string")
    found = urls.url_filter(with_clashes(pages.union(odd)))
    assert found.count() == pages.count() + odd.count()
    assert set(CLASHING) <= set(found.columns)
    for url, host, path, rule, verdict, label, address in rows_of(found, "url", "host", "path", "rule", "verdict", "label", "address"):
        assert (host, path) == plain_parts(url)
        best = plain_rule(host, path)
        assert rule == (best and best[1]) and verdict in ("allow", "block") and label == "own label" and address == "own address"
        if best:
            assert verdict == best[0]
    assert urls.url_filter(pages.limit(0)).count() == 0


def test_likelihood_by_plain_counts():
    """The hashed tables give what exact counts give where no two strings share a slot."""
    texts = [b"www.a.com/en/1", b"www.b.com/de/22", b"a.com/en/1"]
    block = Block(pa.array([t.decode() for t in texts]))
    _, slots = urls._slots(block)
    counts = np.stack([np.bincount(s, minlength=urls.SLOTS) for s in slots]).astype(float)
    got = urls._log_likelihood(counts, slots)
    context, both = Counter(), Counter()
    padded = [bytes(urls.ORDER) + t for t in texts]
    for t in padded:
        for i in range(urls.ORDER, len(t)):
            for o in range(urls.ORDER + 1):
                context[o, t[i - o : i]] += 1
                both[o, t[i - o : i + 1]] += 1
    want = []
    for t in padded:
        for i in range(urls.ORDER, len(t)):
            p = 1 / 256
            for o in range(urls.ORDER + 1):
                p = (both[o, t[i - o : i + 1]] + urls.SHORTER * p) / (context[o, t[i - o : i]] + urls.SHORTER)
            want.append(math.log(p))
    assert got == pytest.approx(want, abs=1e-9)


def test_unlisted_urls_go_with_their_like(spark):
    rows = [(i, f"http://h{i % 7}.com/good/{i}") for i in range(400)] + [(400 + i, f"http://h{i % 7}.net/es/bad/{i}") for i in range(400)]
    rows += [(1000, "http://h3.org/good/77"), (1001, "http://h3.org/es/bad/77")]
    got = dict(rows_of(urls.url_filter(spark.createDataFrame(rows, "page_id long, url string")), "page_id", "verdict"))
    assert got[1000] == "allow" and got[1001] == "block"


def plain_score(address, counts):
    """Difference of the log-likelihoods a byte by exact counts of (order, context) and (order, context, byte) of each class."""
    padded, gain = bytes(urls.ORDER) + address, 0.0
    for i in range(urls.ORDER, len(padded)):
        for sign, found in ((1, counts["allow"]), (-1, counts["block"])):
            p = 1 / 256
            for o in range(urls.ORDER + 1):
                p = (found[o, padded[i - o : i + 1]] + urls.SHORTER * p) / (found[o, padded[i - o : i], None] + urls.SHORTER)
            gain += sign * math.log(p)
    return gain / max(len(address), 1)


def test_scores_of_many_contexts_by_plain_counts(spark):
    """More distinct strings than any table of fixed size would keep apart."""
    rng = np.random.default_rng(3)
    rows = [(i, f"http://h{i % 7}.{kind}/{rng.integers(10**9)}/{rng.integers(10**9):x}") for i in range(6000) for kind in ("com", "net/es")]
    rows += [(9000 + i, f"http://h{i}.org/{rng.integers(10**9)}") for i in range(50)]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "page_id long, url string")
    got = rows_of(urls.url_filter(df), "host", "path", "rule", "score")
    names = [(h + p).encode() for h, p, _, _ in got]
    lists = spark.createDataFrame([(n.decode(),) for n in names], "a string")
    held = {a for a, in rows_of(lists.where(f"pmod(xxhash64('held', a), {urls.HELD_OUT}) = 0"), "a")}
    counts = {"allow": Counter(), "block": Counter()}
    for (_, _, rule, _), name in zip(got, names):
        if rule and name.decode() not in held:
            found, padded = counts[dict((r, v) for v, r in urls.RULES)[rule]], bytes(urls.ORDER) + name
            for i in range(urls.ORDER, len(padded)):
                for o in range(urls.ORDER + 1):
                    found[o, padded[i - o : i], None] += 1
                    found[o, padded[i - o : i + 1]] += 1
    assert len(counts["allow"]) + len(counts["block"]) > 2 * 32_768
    for (_, _, _, score), name in zip(got, names):
        assert score == pytest.approx(plain_score(name, counts), abs=1e-9)
