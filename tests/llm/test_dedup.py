"""Operators 2, 5 and 8 against brute force, on given documents and odd rows."""

import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from llm_rows import ODD

from tidemark.llm import bwt_merge, fm_index, packing, segments, simhash, substring_dedup, suffix_dedup, wordcodes
from tidemark.llm.bwt_merge import merged, repeated_intervals, transformed
from tidemark.llm.components import components
from tidemark.llm.fm_index import FMIndex, repeated_windows

WORDS = re.compile("[^\x20\x09-\x0D]+")


def distinct(rows):
    """Equal rows are one document; null ids first."""
    return sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def words_kept(rows, length):
    count = Counter()
    for _, text in distinct(rows):
        w = WORDS.findall(text)
        count.update(tuple(w[i:i + length]) for i in range(len(w) - length + 1))
    out = {}
    for d, text in distinct(rows):
        w = WORDS.findall(text)
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d, text] = (len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


def bytes_kept(rows, length):
    seen, out = set(), {}
    for d, text in distinct(rows):
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(b[i:i + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[d, text] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def given(spark, n):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id > 14").select("doc_id", "text").limit(n).collect()]


def check(got, want, rows):
    """Rows under one id may come in any order."""
    a = sorted((str(r[0]), *r[1:]) for r in got)
    b = sorted((str(d), *want[d, t or ""]) for d, t in rows)
    assert a == b


@pytest.mark.parametrize("dense", [20_000, 1])
def test_substrings(spark, make, dense):
    rows = given(spark, 60) + ODD
    got = substring_dedup.without_repeats(make(rows), dense=dense).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    check(got, words_kept(rows, 35), rows)


@pytest.mark.parametrize("dense", [20_000, 1])
def test_suffixes(spark, make, dense):
    rows = [r for r in given(spark, 60) + ODD if r[0] != 4 or r[1]]
    got = suffix_dedup.without_repeats(make(rows), dense=dense).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    check(got, bytes_kept(rows, 100), rows)


def test_empty_tables(make, spark):
    empty = make(ODD).limit(0)
    assert substring_dedup.without_repeats(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_backward_search():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 3, n).astype(np.uint64) for n in (40, 41, 60, 35)]
    index = FMIndex(texts)
    for t in texts:
        for at, n in ((0, 4), (7, 6), (20, 9)):
            word = t[at:at + n]
            lo, hi = np.zeros(1, np.int64), np.full(1, index.size)
            for k in range(n - 1, -1, -1):
                lo, hi = index.extend(index.text[index.starts[[i for i, x in enumerate(texts) if x is t][0]] + at + k][None], lo, hi)
            count = sum((u[i:i + n] == word).all() for u in texts for i in range(len(u) - n + 1))
            assert hi[0] - lo[0] == count


@pytest.mark.parametrize("seed", range(8))
def test_windows_of_random_texts(seed):
    """Few symbols and short windows, so that matches of every length occur."""
    rng = np.random.default_rng(seed)
    length = 5
    texts = [rng.integers(0, 2 + seed % 3, rng.integers(length, length + 60)).astype(np.uint64) for _ in range(12)]
    count = Counter(t[i:i + length].tobytes() for t in texts for i in range(len(t) - length + 1))
    want = [[count[t[i:i + length].tobytes()] > 1 for i in range(len(t) - length + 1)] for t in texts]
    bits = repeated_windows(texts, length, np.zeros(len(texts), bool))
    assert [[bool(int(b) >> i & 1) for i in range(len(w))] for b, w in zip(bits, want)] == want
    text, offset, block = repeated_intervals([t.astype(np.uint8) for t in texts], length)
    groups = {}
    for t, o, b in zip(text.tolist(), offset.tolist(), block.tolist()):
        groups.setdefault(b, set()).add((t, o))
    expected = {}
    for t, x in enumerate(texts):
        for i in range(len(x) - length + 1):
            expected.setdefault(x[i:i + length].tobytes(), set()).add((t, i))
    assert sorted(map(sorted, groups.values())) == sorted(sorted(v) for v in expected.values() if len(v) > 1)


def test_the_merge_rests_on_the_order_of_each_part():
    rng = np.random.default_rng(6)
    passage = rng.integers(1, 5, 200)
    parts = [[np.concatenate([rng.integers(1, 5, 50), [side], passage, [side], rng.integers(1, 5, 50)])] for side in (6, 7)]
    first, second = (transformed(p)[0] for p in parts)
    rows, block = merged([first, second], 100)
    assert len(rows) == 202 and (np.bincount(block)[1:] == 2).all()  # 101 windows, once in each part
    assert len(merged([first, rng.permutation(second)], 100)[0]) == 0


@pytest.mark.parametrize("length", [99, 100])
def test_the_merge_sorts_only_rows_that_become_whole_windows(monkeypatch, length):
    """Each of 200 alike texts has 103 symbols and few windows; once a round took all rows that had not run out yet."""
    rng = np.random.default_rng(8)
    text = rng.integers(1, 90, 103)
    transforms = [transformed([text] * 100)[0] for _ in range(2)]
    sizes, sort = [], np.argsort
    monkeypatch.setattr(bwt_merge.np, "argsort", lambda x, **kw: sizes.append(len(x)) or sort(x, **kw))
    rows, block = merged(transforms, length)
    monkeypatch.undo()
    windows = len(text) - length + 1
    assert len(rows) == 200 * windows and (np.bincount(block)[np.unique(block)] == 200).all()
    assert max(sizes[len(transforms):]) == 200 * windows


def test_many_documents_without_an_id(spark, make):
    passage = " ".join(f"shared{k}" for k in range(40))
    rows = [(None, f"{' '.join(f'a{k}x{j}' for j in range(30))} {passage} {' '.join(f'b{k}x{j}' for j in range(30))}") for k in range(150)]
    got = substring_dedup.without_repeats(make(rows)).collect()
    assert [(r["n_words"], r["n_removed"]) for r in got] == [(100, 40)] * 150
    removed = sorted(r["n_removed"] for r in suffix_dedup.without_repeats(make(rows)).collect())
    assert removed[0] == 0 and removed[1] >= len(passage) and removed.count(0) == 1


def fingerprint(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = WORDS.findall(w)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("hot", [1 << 16, 1, 0])
def test_simhash(spark, make, hot):
    rows = given(spark, 120) + ODD
    near = "one two three four five six seven eight nine ten " * 8
    rows += [(1000 + k, near + f"tail{k}") for k in range(40)]
    got = simhash.near_duplicates(make(rows), hot=hot).collect()
    fps = [fingerprint(t) for _, t in rows]
    groups = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and groups[i] != groups[j]:
                old = groups[i]
                groups = [groups[j] if g == old else g for g in groups]
    least = {}
    for (d, _), g in zip(rows, groups):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    want = [(str(d), f"{fp:016x}", least.get(g)) for (d, _), fp, g in zip(rows, fps, groups)]
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted(want)


def test_every_pair_meets_at_an_anchor():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    for flips in (0, 1, 2):
        other = fps.copy()
        for _ in range(flips):
            other ^= np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64)
        home = simhash.home_anchors(fps)
        assert all(h in a for h, a in zip(home, simhash.anchors(other, 2)))


def test_components_of_a_long_path(spark):
    path = spark.range(60).selectExpr("id as a", "id + 1 as b").union(spark.sql("select 100L, 200L union all select 200L, 300L"))
    got = {r[0]: r[1] for r in components(path).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 200: 100, 300: 100}


def test_suffixes_are_ordered_with_little_sorting(monkeypatch):
    """Suffixes told apart by the first sort are not sorted again."""
    rng = np.random.default_rng(5)
    for sigma in (1, 3, 90):
        symbols = rng.integers(1, sigma + 1, 3000)
        ends = np.unique(np.append(rng.integers(0, 3000, 60), 2999))
        symbols[ends] = 0
        marks = {int(e): k for k, e in enumerate(ends)}

        def suffix(at):
            end = int(ends[np.searchsorted(ends, at)])
            return [len(ends) + int(s) for s in symbols[at:end]] + [marks[end]]

        sizes, sort = [], np.argsort
        monkeypatch.setattr(fm_index.np, "argsort", lambda x, **kw: sizes.append(len(x)) or sort(x, **kw))
        order = fm_index.suffix_order(symbols, ends)
        monkeypatch.undo()
        assert order.tolist() == sorted(range(3000), key=suffix)
        assert sigma < 90 or sum(sizes) < 1.5 * 3000


def test_a_shard_takes_few_bytes_a_symbol():
    """Of near copies, where most windows stay to the last round; the merge once took 80 and more."""
    rng = np.random.default_rng(5)
    passage = rng.integers(97, 123, 163, dtype=np.uint8)
    texts = [passage.copy() for _ in range(2000)]
    for text in texts:
        text[rng.integers(163)] = rng.integers(97, 123)
    size, ranks, starts = 2000 * 163, np.arange(2000), np.zeros(2000, np.int64)
    tracemalloc.start()
    try:
        bits = suffix_dedup.later_windows(texts, None, ranks, starts, 100)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    seen, late = set(), []
    for text in texts:
        windows = [text[i:i + 100].tobytes() for i in range(64)]
        late.append(sum(1 << i for i, w in enumerate(windows) if w in seen))
        seen.update(windows)
    assert bits.tolist() == late
    assert peak / size < 60


def test_other_operators_find_no_tables_of_the_packer():
    codes = wordcodes.kept_codes(public_tokenizers.path("word_bpe_49k.json"), packing._packed, 1000)
    codes[b"word"]
    assert wordcodes.kept_codes.cache_info().currsize
    assert list(segments._shards(None, segments.Shape(100, 40), "uint8")(iter([]))) == []
    assert not wordcodes.kept_codes.cache_info().currsize


def test_an_id_is_one_object_in_all_words():
    codes = wordcodes.WordCodes(public_tokenizers.path("word_bpe_49k.json"), packing._packed, 1000)
    found = [k for c in "abcdefgh" for k in codes.ids(f"thing{c}zqx".encode())]
    assert max(found) > 300 and len({id(k) for k in found}) == len(set(found)) < len(found)


def test_texts_are_returned_in_small_parts(spark, make):
    """More rows than are cut together: each keeps its own, in either operator."""
    rows = [(k, f"{k} " + " ".join(f"w{(k // 2) * 50 + j}" for j in range(40)) if k % 7 else None) for k in range(700)]
    expected, got = bytes_kept(rows, 100), suffix_dedup.without_repeats(make(rows).coalesce(1)).collect()
    assert len(got) == 700 and all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id, r.row.text or ""] for r in got)
    words = {d: v for (d, _), v in words_kept(rows, 35).items()}
    again = substring_dedup.without_repeats(make(rows).coalesce(1)).collect()
    assert len(again) == 700 and all((r.n_words, r.n_removed, r.kept_sha256) == words[r.doc_id] for r in again)
