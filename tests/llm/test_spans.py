"""Sentence spans against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from __spark_entry__ import queries
from tripweave.llm import spans
from tripweave.llm import text as tx


def pieces(text, long=16, gap=8):
    """Sentences, longer ones cut, by the rule in the module's docstring, word by word."""
    ws = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    h = []
    for a, b in ws:
        word = np.frombuffer(lowered(text[a:b]).encode(), np.uint8)
        h.append(int(tx.hash_spans(word, np.array([0]), np.array([len(word)]))[0]))
    least = set()
    for i in range(len(h) - gap + 1):
        least |= {j for j in range(i, i + gap) if h[j] == min(h[i : i + gap])}
    sentences = []
    for i, (a, _) in enumerate(ws):
        ended = i and (text[ws[i - 1][1] - 1] in ".!?" or "\n" in text[ws[i - 1][1] : a])
        if not i or ended:
            sentences.append([])
        sentences[-1].append(i)
    out = []
    for sentence in sentences:
        own = []
        for i in sentence:
            own.append(ws[i])
            if i == sentence[-1] or (len(sentence) > long and i in least):
                out.append(own)
                own = []
    return out


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def brute(docs, min_words=20, min_pieces=2):
    """Ranges to remove by document, and where they stand first: *every* run of pieces that
    is long enough. Runs of more pieces than ``min_words`` + 4 are unions of shorter ones."""
    places = {}
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0], str(d[1]))):
        low = lowered(text)
        ps = pieces(text)
        ends = np.cumsum([0, *map(len, ps)])
        for i in range(len(ps)):
            for j in range(i + min_pieces, min(len(ps), i + min_words + 4) + 1):
                if ends[j] - ends[i] >= min_words:
                    key = tuple(low[a:b] for p in ps[i:j] for a, b in p)
                    places.setdefault(hash(key), []).append((doc_id, ps[i][0][0], ps[j - 1][-1][1]))
    cut, first = {}, {}
    for found in places.values():
        for doc_id, a, b in sorted(found)[1:]:
            cut.setdefault(doc_id, set()).add((a, b))
            first.setdefault(doc_id, set()).add(sorted(found)[0][0])
    merged = {}
    for doc_id, ranges in cut.items():
        own = []
        for a, b in sorted(ranges):
            if own and a <= own[-1][1]:
                own[-1] = (own[-1][0], max(b, own[-1][1]))
            else:
                own.append((a, b))
        merged[doc_id] = own
    return merged, {k: sorted(v) for k, v in first.items()}


def left_of(text, ranges):
    for a, b in reversed(ranges):
        text = text[:a] + text[b:]
    return text


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want, first = brute(docs)
    rows = queries()["op10_sentence_spans"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(want)
    for r in rows:
        ranges = want[r.doc_id]
        kept = left_of(dict(docs)[r.doc_id], ranges)
        assert r.spans == ",".join(f"{a}:{b}" for a, b in ranges) and r.n_spans == len(ranges)
        assert set(r.first_doc_ids) <= set(first[r.doc_id]) and min(r.first_doc_ids) == min(first[r.doc_id])
        assert (r.kept_chars, r.kept_sha256) == (len(kept), hashlib.sha256(kept.encode()).hexdigest())


def words(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_passages_of_fifty_words_are_found_anywhere(docs_of):
    passage = words("p", 55)
    shapes = {
        "sentences": " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(passage)),
        "commas": " ".join(w + ("," if i % 7 == 6 else "") for i, w in enumerate(passage)),
        "line": " ".join(passage),
        "nothing": " ".join(passage),
    }
    for name, text in shapes.items():
        glue = "\n" if name == "line" else " "
        docs = [(i, " ".join(words(f"a{i}x", 30)) + glue + text + glue + " ".join(words(f"b{i}x", 30)))
                for i in range(3)]
        got = {r.doc_id: r for r in spans.repeated_spans(docs_of(*docs)).collect()}
        assert set(got) == {1, 2} and got[1].first_doc_ids == [0], name
        assert got == {} or all("a1x" not in docs[1][1][s["start"] : s["end"]] for s in got[1].spans)


def test_short_lines_and_clean_documents_stay(docs_of):
    line = "Licensed under the Apache License, Version 2.0."
    docs = [(i, " ".join(words(f"d{i}x", 60)) + ".\n" + line) for i in range(20)]
    assert spans.repeated_spans(docs_of(*docs)).count() == 0


def test_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r for r in spans.repeated_spans(odd_docs).collect()}
    assert set(got) <= {5, 6} and got[6].first_doc_ids == [5]
    left = spans.cut(odd_docs, spans.repeated_spans(odd_docs))
    assert set(odd_docs.columns) < set(left.columns)
    assert spans.repeated_spans(no_docs).count() == 0
    assert spans.cut(no_docs, spans.repeated_spans(no_docs)).count() == 0


def test_repeated_rows_of_an_id_are_one_document(docs_of):
    text = " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words("q", 60)))
    assert spans.repeated_spans(docs_of((1, text), (1, text))).count() == 0
    got = spans.repeated_spans(docs_of((1, text), (1, text), (2, text))).collect()
    assert [(r.doc_id, r.first_doc_ids) for r in got] == [(2, [1])]


def kept_by_second(passage, around):
    """The passage's words that stay in the second of two texts that hold it."""
    runs = []
    texts = [" ".join([*before, *passage, *after]) for before, after in around]
    for text in texts:
        _, run, _, start, end = spans._runs(pa.array([text]), 2, 20)
        runs.append(list(zip(run.tolist(), start.tolist(), end.tolist())))
    known = {run for run, _, _ in runs[0]}
    cut = [(a, b) for run, a, b in runs[1] if run in known]
    at, kept = len(" ".join(around[1][0])) + 1, []
    for i, word in enumerate(passage):
        if not any(a <= at and at + len(word) <= b for a, b in cut):
            kept.append(i)
        at += len(word) + 1
    return kept


def test_random_passages_are_found_but_for_a_few_words_at_their_ends():
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    texts = [t.split() for t in table["text"].to_pylist() if t]
    long = [t for t in texts if len(t) > 120]
    rng = random.Random(7)
    for trial in range(400):
        plain = trial % 2
        ws = [rng.choice(long) for _ in range(3)]
        if plain:
            ws = [[re.sub(r"[.!?,;:]+$", "", w) or "x" for w in own] for own in ws]
        i = rng.randrange(len(ws[0]) - 51)
        around = []
        for own in ws[1:]:
            j, k = rng.randrange(len(own) - 40), rng.randrange(len(own) - 40)
            around.append((own[j : j + 40], own[k : k + 40]))
        kept = kept_by_second(ws[0][i : i + 51], around)
        inside = [n for n in kept if 16 <= n <= 34]
        assert not inside, (trial, kept)


def test_the_last_short_sentence_of_a_passage_goes_too():
    passage = [f"p{i}" + ("." if i in (15, 29, 37) else "") for i in range(38)]
    before = [words("a", 29) + ["a."], words("b", 29) + ["b."]]
    assert not kept_by_second(passage, [(b, words(f"c{i}x", 30)) for i, b in enumerate(before)])


def test_cuts_do_not_depend_on_the_other_texts_of_a_batch():
    texts = ["", " ".join(words("q", 40)), None, "one", " ".join(words("r", 33))]
    _, together, *_ = spans._runs(pa.array(texts), 2, 20)
    alone = [spans._runs(pa.array([t]), 2, 20)[1].tolist() for t in texts if t and " " in t]
    assert sorted(together.tolist()) == sorted(sum(alone, []))


def test_three_short_sentences_of_twenty_words_are_found(docs_of):
    passage = "p0 p1 p2 p3 p4 p5. p6 p7 p8 p9 p10 p11 p12 p13. p14 p15 p16 p17 p18 p19."
    docs = [(i, f"{' '.join(words(f'a{i}x', 12))}. {passage} {' '.join(words(f'b{i}x', 12))}.") for i in range(2)]
    (row,) = spans.repeated_spans(docs_of(*docs)).collect()
    assert [docs[1][1][s["start"] : s["end"]] for s in row.spans] == [passage]


def test_cuts_fall_on_ends_of_sentences(docs_of):
    rng = random.Random(5)
    stock = [" ".join(words(f"s{k}x", rng.randrange(4, 14))) + "." for k in range(12)]
    docs = [(i, " ".join(rng.choice(stock) for _ in range(rng.randrange(2, 9)))) for i in range(40)]
    want, _ = brute(docs)
    got = {r.doc_id: [(s["start"], s["end"]) for s in r.spans] for r in spans.repeated_spans(docs_of(*docs)).collect()}
    assert got == want and want
    for doc_id, ranges in got.items():
        text = dict(docs)[doc_id]
        assert all((a == 0 or text[a - 2] == ".") and text[b - 1] == "." for a, b in ranges)


def test_runs_of_equal_first_hash_are_told_apart_by_the_second():
    texts = ["a b c d. " * 6, "a b c d.\n" * 6, "A B C D. " * 6]
    _, run, proof, *_ = spans._runs(pa.array(texts), 2, 20)
    assert len(set(zip(run.tolist(), proof.tolist()))) == len(set(run.tolist())) == len(set(proof.tolist()))


def shuffle_bytes(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = (p for d in folders for p in Path(d.getPath()).rglob("shuffle_*.data"))
    return {p: p.stat().st_size for p in files}


def test_finished_steps_leave_no_shuffle_files(spark, docs_of):
    """Nor does the join with the ranges shuffle texts that lose nothing."""
    text = " ".join(words("q", 60))
    docs = docs_of(*((i, " ".join(words(f"d{i}x", 40)) + " " + text * (i % 50 == 0)) for i in range(500)))
    before = shuffle_bytes(spark)
    left = spans.cut(docs, spans.repeated_spans(docs))
    time.sleep(1)
    # All that may be there is that of the last count.
    assert sum(n for p, n in shuffle_bytes(spark).items() if p not in before) < 1000
    assert "_bits" in left._jdf.queryExecution().executedPlan().toString()
    assert [r.doc_id for r in left.orderBy("doc_id").collect()] == list(range(50, 500, 50))
