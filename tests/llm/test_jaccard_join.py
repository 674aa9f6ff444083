"""N-gram Jaccard join against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from __spark_entry__ import queries
from tripweave.llm import jaccard_join as jj
from tripweave.llm.components import components


def shingles(text, k=3):
    low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else {tuple(ws)} - {()}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(docs, k=3, percent=90):
    sets = [(i, shingles(t, k)) for i, t in docs if i is not None]
    index, links = defaultdict(list), []
    for n, (i, s) in enumerate(sets):
        common = Counter(m for x in s for m in index[x])
        for m, c in common.items():
            j, t = sets[m]
            if 100 * c >= percent * (len(s) + len(t) - c):
                links.append((i, j))
        for x in s:
            index[x].append(n)
    return {i: len(s) for i, s in sets}, roots({i for i, _ in sets}, links)


def check(df, docs, **how):
    got = {r.doc_id: r for r in jj.jaccard_components(df, **how).collect()}
    sizes, want = brute(docs, **how)
    assert {i: r.n_shingles for i, r in got.items() if i is not None} == sizes
    assert {i: r.component_id for i, r in got.items() if i is not None} == want


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries()["op5_ngram_jaccard_join"](spark, sf_dir).collect()
    sizes, want = brute(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (sizes[i], want[i]) for i in want}


@pytest.mark.parametrize("percent, k", [(90, 3), (80, 5)])
def test_chains_of_near_copies(docs_of, percent, k):
    rng = random.Random(percent)
    docs = []
    for group in range(6):
        n = rng.choice([4, 12, 60, 200])
        base = [f"w{group}x{i}" for i in range(n)]
        for copy in range(25):
            own = list(base)
            for _ in range(rng.randrange(max(2, n // 12))):
                own[rng.randrange(n)] = f"edit{rng.randrange(9)}"
            docs.append((1000 * group + copy, " ".join(own)))
    docs += [(9001 + i, t) for i, t in enumerate(["", "a", "a", "a b", "A  b", "a b c", "a b c d"])]
    rng.shuffle(docs)
    check(docs_of(*docs), docs, k=k, percent=percent)


def test_buckets_beyond_a_chunk(docs_of, monkeypatch):
    monkeypatch.setattr(jj, "CHUNK", 8)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(150)] = f"e{rng.randrange(1000)}"
        docs.append((i, " ".join(own)))
    check(docs_of(*docs), docs)


def test_odd_rows(odd_docs, no_docs):
    got = jj.jaccard_components(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 7)] == [0, 0, 0, 1, 4]
    assert [by[i].component_id for i in (1, 2, 3, 4, 7)] == [1, 2, 3, 4, 7]
    assert by[6].component_id == 5 and by[None].component_id is None
    assert jj.jaccard_components(no_docs).count() == 0


def test_bands_hold_all_similar_sizes():
    for percent in (90, 80):
        bands = jj.Bands(percent)
        for s in range(1, 1500):
            band, own, up = bands.layouts(s)
            for t in range(s, s * 100 // percent + 1):
                other, t_own, _ = bands.layouts(t)
                difference = bands.bound(s + t)
                if difference:  # else only equal sets are similar
                    assert other in (band, band + 1)
                    blocks = own if other == band else up
                    assert blocks > difference and (other == band or blocks == t_own)


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_probe(percent):
    rng, bands = np.random.default_rng(percent), jj.Bands(percent)
    for _ in range(1500):
        s = rng.integers(0, 2**63, rng.integers(4, 400))
        drop = rng.integers(0, max(1, bands.most(len(s)) // 2 + 1))
        t = np.concatenate([s[drop:], rng.integers(0, 2**63, rng.integers(0, drop + 1))])
        common = len(s) - drop
        if 100 * common < percent * (len(s) + len(t) - common):
            continue
        found = []
        for x in (np.sort(s.astype(np.uint64)), np.sort(t.astype(np.uint64))):
            kinds = jj._kinds(x, bands)
            found.append({k for b, m in kinds for k in jj.probes(x, b, m, bands.most(len(x))).tolist()})
        assert found[0] & found[1] or (drop == 0 and len(s) == len(t))


def test_hamming_distance_bounds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        s = set(rng.integers(0, 2**63, rng.integers(1, 200)).tolist())
        t = (s - set(list(s)[: rng.integers(0, 20)])) | set(rng.integers(0, 2**63, rng.integers(0, 20)).tolist())
        a, b = (jj.sketch(np.array(sorted(x), np.uint64), 7) for x in (s, t))
        assert int(np.bitwise_count((a ^ b).view(np.uint64)).sum()) <= len(s ^ t)


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)]
    links += [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(150)]
    links += [(7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert {r.node: r.component for r in got.collect()} == roots({x for l in real for x in l}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_bucket_goes_through_a_window(spark, docs_of):
    """A group of equal texts is not gathered in one task for each of its keys."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(i, text) for i in range(40)] + [(90, text + " more"), (91, "something else here")]
    got = {r.doc_id: r.component_id for r in jj.jaccard_components(docs_of(*rows)).collect()}
    assert got == dict.fromkeys([*range(40), 90], 0) | {91: 91}
    runs = store.executionsList(int(before), 1000)
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("Window" in p for p in plans)
