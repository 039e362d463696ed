"""Line dedup and its perfect hash, against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import ODD
from test_dedup import given

from tidemark.llm import line_dedup
from tidemark.llm.perfect_hash import PerfectHash


def key_of(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\v\f\r"))


def brute(rows, documents, least=1):
    cut = [(d, (t or "").split("\n")) for d, t in rows]
    seen = Counter(k for _, lines in cut for k in {key_of(x) for x in lines} if len(k) >= least)
    out = []
    for d, lines in cut:
        kept = [x for x in lines if not (len(key_of(x)) >= least and seen[key_of(x)] >= documents)]
        out.append((str(d), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out)


def found(df):
    return sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_sha256"], r["kept"]) for r in df.collect())


LINES = [(2000 + k, f" \tCommon LINE é\r\nown {k}\n\n  \nÉ kept\ncommon line é \nrare {k % 7}") for k in range(30)]
LINES += [(3000 + k, "copy of all\nCommon line É\nshort\n") for k in range(40)] + [(3100, "common line é\n" * 500), (3101, "\n" * 300)]


@pytest.mark.parametrize("documents, least", [(10, 1), (2, 1), (4, 7), (1, 2)])
def test_lines_go_by_brute_force(spark, make, documents, least):
    rows = given(spark, 150) + ODD + LINES
    assert found(line_dedup.without_common_lines(make(rows).repartition(3), documents, least)) == brute(rows, documents, least)


def test_small_blocks_and_many_shards(make, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD", 8)
    rows = ODD + LINES
    assert found(line_dedup.without_common_lines(make(rows).repartition(5), 5)) == brute(rows, 5)
    assert line_dedup.without_common_lines(make(rows).limit(0)).count() == 0


def test_blocks_hold_a_repeated_line_once():
    block = line_dedup._Block()
    for k in range(100):
        block.add(b"the same\n" * 3 + b"again %d" % (k % 2), 1)
    keys = docs = 0
    for row in block.packets(2).to_pylist():
        keys += len(row["lines"]) // 16
        docs += np.frombuffer(row["docs"], "<u8").sum()
    assert (keys, docs) == (3, 200)


def test_arrays_say_which_lines_are_common(make):
    packed = line_dedup.packets(make(LINES), 1, 3)
    rows = line_dedup.index(packed, 12).collect()
    assert len({r["shard"] for r in rows}) == len(rows) > 3
    want = Counter(k for _, t in LINES for k in {key_of(x) for x in t.split("\n")} if k)
    counts = np.concatenate([np.frombuffer(r["counts"], "u2") for r in rows])
    assert sorted(counts) == sorted(min(12, n) for n in want.values())


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_knows_strangers(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 64, (n + 5000, 2), np.uint64)
    keys[1:n // 2, 0] = keys[0, 0]  # many keys with one word in common
    own, strange = keys[:n], keys[n:]
    counts = rng.integers(1, 100_000, n).astype(np.uint64)
    made = PerfectHash.of(own, counts, (1 << 16) - 1)
    assert sorted(made._place(own)) == list(range(n))
    assert (made.count(own) == np.minimum(counts, (1 << 16) - 1)).all()
    assert not made.count(strange).any()
    assert made.sizes.sum() <= 6 * n + 64 * 41
