"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control.

Everything is built-in column expressions: no user function, no shuffle of texts. The battery
looks at tokens that mix letters and digits. From its characters it infers the encoding of a token, and with
it the alphabet that a random token would be drawn from. Three tests ask whether it could be random:
chi-squared uniformity over the alphabet, the number of runs above and below the middle of the alphabet,
and the correlation of neighbours. Their p-values are combined, and a first Benjamini-Hochberg step over these
tells which candidates are not random and so no secrets. The other p-value is of the hypothesis that a token is an
identifier: its characters follow a chain of letter case, vowels, digits and signs, held to the alphabet of
the encoding. If that chain gives a token the probability Q and the uniform law U, U / Q has
mean 1 under the chain, so Q / U is a p-value for any length and alphabet. A second step over the candidates left
decides which are discoveries. Both steps go by encoding and class of lengths, so short tokens must earn their place
among short ones, and need only a histogram of both p-values, whose size is fixed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import let, texts

#: Fixed patterns and lengths. A kind: what tells that a text can hold it, the pattern, the group whose length counts, the least length.
KINDS = {
    "assign": ("(?i)passw(?:or)?d|secret|token|api_?key",
               "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    "access": ("AKIA", "AKIA[A-Z0-9]+", 0, 18),
    "hex": ("[0-9a-f]{16}", "[0-9a-f]+", 0, 16),
}
#: Letters and digits with the signs of the usual encodings; only such tokens are tested. What follows an equals sign is a
#: token of its own, and up to two of these are padding only where nothing follows them.
TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?"

#: Encoding -> (pattern of the whole token, alphabet in order).
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = {
    "hex": ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    "HEX": ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    "base32": ("^[A-Z2-7]+=*$", _UPPER + "234567"),
    "base36": ("^[a-z0-9]+$", _DIGITS + _LOWER),
    "BASE36": ("^[A-Z0-9]+$", _DIGITS + _UPPER),
    "base62": ("^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
    "base64": ("^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    "base64url": ("^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
}

#: All signs at once, for tokens of no single encoding.
MIXED = ENCODINGS["base64"][1] + "-_"

#: Shares of what follows a small letter, a great one, a digit or a sign in identifiers, and of what starts them.
FOLLOWS = {"a": (0.80, 0.06, 0.06, 0.08), "A": (0.28, 0.60, 0.05, 0.07), "0": (0.09, 0.09, 0.70, 0.12), "-": (0.45, 0.20, 0.30, 0.05),
           "": (0.50, 0.30, 0.15, 0.05)}
#: Letters of European languages, per mille, and the share of consonants after a vowel and after a consonant.
LETTERS = dict(zip(_LOWER, (82, 15, 28, 43, 127, 22, 20, 61, 70, 3, 8, 40, 24, 67, 75, 19, 2, 60, 63, 91, 28, 10, 24, 3, 20, 2)))
CONSONANT = {True: 0.85, False: 0.50}


@dataclass(frozen=True)
class Battery:
    """``random`` is the rate of false rejections by the combined randomness test, ``rate`` the share of false discoveries."""

    random: float = 0.001
    rate: float = 0.01
    lengths: tuple[int, ...] = (24, 32, 48)
    steps: int = 20  # histogram bins per power of ten
    powers: int = 20


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, to about 1e-4, and monotone beyond."""
    return 1 / (1 + F.exp(F.least(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z, F.lit(600.0))))


def matches(text: Column, pattern: str, hint: str, group: int = 0, least: int = 1) -> Column:
    """Leftmost non-overlapping matches with their places: array of (start, end, value).

    Each piece extracted is the text since the last match and the match; the lengths of
    the pieces add up to places. A match whose ``group`` is shorter than ``least`` is dropped, not retried.
    """
    whole = f"(?s)\\G(.*?)({pattern})"  # \\G: after the last match, no start but its end is tried
    pieces = F.when(text.rlike(hint), F.arrays_zip(
        F.regexp_extract_all(text, F.lit(whole), 1).alias("gap"), F.regexp_extract_all(text, F.lit(whole), 2).alias("value"),
        F.regexp_extract_all(text, F.lit(whole), 2 + group).alias("part")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long,value:string>>").alias("found"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        keep = F.array(F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value")))
        return F.struct(end.alias("at"), F.when(F.length(x["part"]) >= least, F.concat(acc["found"], keep)).otherwise(acc["found"]).alias("found"))

    return F.coalesce(F.aggregate(pieces, start, add, lambda acc: acc["found"]), F.array().cast("array<struct<start:long,end:long,value:string>>"))


def _ratios(alphabet: str) -> list[float]:
    """Log of identifier over uniform probability: of each first character, then of each pair, the latter given the former."""

    def kind(c: str) -> str:
        return "a" if c in _LOWER else "A" if c in _UPPER else "0" if c in _DIGITS else "-"

    def law(last: str) -> list[float]:
        weights = []
        for c in alphabet:
            k = kind(c)
            weight = FOLLOWS[kind(last) if last else ""]["aA0-".index(k)]
            alike = [x for x in alphabet if kind(x) == k]
            if k in "aA":
                vowel = c.lower() in "aeiou"
                if last and kind(last) in "aA":
                    share = CONSONANT[last.lower() in "aeiou"]
                    weight *= 1 - share if vowel else share
                    alike = [x for x in alike if (x.lower() in "aeiou") == vowel]
                weight *= LETTERS[c.lower()] / sum(LETTERS[x.lower()] for x in alike)
            else:
                weight /= len(alike)
            weights.append(weight)
        return [math.log(len(alphabet) * w / sum(weights)) for w in weights]

    return [x for last in ("", *alphabet) for x in law(last)]


@cache
def _table() -> tuple[str, tuple[int, ...]]:
    """The ratios of all alphabets, listed, and where each alphabet starts."""
    parts = [_ratios(a) for a in (*[a for _, a in ENCODINGS.values()], MIXED)]
    return " ".join(f"{x:.4f}" for p in parts for x in p), tuple(accumulate((len(p) for p in parts[:-1]), initial=0))


def tested(value: Column) -> Column:
    """Struct (n, code, random, language): length, place of the encoding, combined p-value of the randomness tests, p-value of identifiers."""
    code = F.coalesce(*[F.when(value.rlike(p), F.lit(k)) for k, (p, _) in enumerate(ENCODINGS.values())], F.lit(len(ENCODINGS)))
    alphabets = F.array(*[F.lit(a) for _, a in ENCODINGS.values()], F.lit(MIXED))
    listed, starts = _table()
    # One literal, folded into an array when the plan is made.
    ratios = F.split(F.lit(listed), " ").cast("array<double>")
    begins = F.array(*[F.lit(s) for s in starts])
    bare = F.regexp_replace(value, "=+$", "")
    n = F.length(bare).cast("double")

    def stats(x: Column) -> Column:
        size = F.length(x["alphabet"]).cast("double")
        chars = F.split(x["bare"], "")
        count = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a + F.pow(
            F.length(x["bare"]) - F.length(F.replace(x["bare"], c, F.lit(""))), F.lit(2.0)))
        return F.struct(
            x["n"].alias("n"), x["code"].alias("code"), size.alias("size"), count.alias("squares"),
            F.transform(chars, lambda c: (F.instr(x["alphabet"], c) - 1).cast("double")).alias("v"))

    def _identifier(x: Column) -> Column:
        begin = begins[x["code"]]
        steps = F.zip_with(F.slice(x["v"], 2, F.size(x["v"])), F.slice(x["v"], 1, F.size(x["v"]) - 1),
                           lambda b, a: ratios[(begin + (a + 1) * x["size"] + b).cast("int")])
        return F.aggregate(steps, ratios[(begin + x["v"][0]).cast("int")], lambda a, r: a + r)

    def moments(x: Column) -> Column:
        mean = F.aggregate(x["v"], F.lit(0.0), lambda a, v: a + v) / x["n"]
        high = F.transform(x["v"], lambda v: v * 2 >= x["size"])
        return F.struct(
            x["n"].alias("n"), x["code"].alias("code"), x["size"].alias("size"), x["squares"].alias("squares"),
            _identifier(x).alias("identifier"),
            F.aggregate(F.filter(high, lambda h: h), F.lit(0.0), lambda a, h: a + 1).alias("n1"),
            (F.lit(1.0) + F.aggregate(F.zip_with(F.slice(high, 2, F.size(high)), F.slice(high, 1, F.size(high) - 1), lambda a, b: a != b),
                                      F.lit(0.0), lambda a, d: a + d.cast("double"))).alias("runs"),
            F.aggregate(x["v"], F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)).alias("spread"),
            F.aggregate(F.zip_with(F.slice(x["v"], 2, F.size(x["v"])), F.slice(x["v"], 1, F.size(x["v"]) - 1), lambda a, b: (a - mean) * (b - mean)),
                        F.lit(0.0), lambda a, d: a + d).alias("serial"))

    def p_values(x: Column) -> Column:
        size, count = x["size"], x["n"]
        free = size - 1
        chi = size / count * x["squares"] - count
        root = (F.pow(F.greatest(chi / free, F.lit(0.0)), F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        n1, n2 = x["n1"], count - x["n1"]
        expected = 2 * n1 * n2 / count + 1
        variance = F.greatest((expected - 1) * (expected - 2) / (count - 1), F.lit(1e-9))
        runs = F.abs(x["runs"] - expected) / F.sqrt(variance)
        serial = F.abs(x["serial"] / F.greatest(x["spread"], F.lit(1e-9))) * F.sqrt(count)
        parts = [_upper_tail(root), F.when(n1 * n2 > 0, 2 * _upper_tail(runs)).otherwise(0.0), 2 * _upper_tail(serial)]
        # Cauchy combination: valid however the tests depend on each other.
        pi = F.lit(math.pi)
        bent = sum((F.tan((F.lit(0.5) - F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-6))) * pi) for p in parts), F.lit(0.0)) / len(parts)
        return F.struct(
            count.cast("int").alias("n"), x["code"].alias("code"), (F.lit(0.5) - F.atan(bent) / pi).alias("random"),
            F.exp(F.least(F.greatest(x["identifier"], F.lit(-100.0)), F.lit(0.0))).alias("language"))

    start = F.struct(code.alias("code"), bare.alias("bare"), n.alias("n"))
    whole = let(start, lambda x: F.struct(x["code"].alias("code"), alphabets[x["code"]].alias("alphabet"), x["bare"].alias("bare"), x["n"].alias("n")))
    return let(whole, lambda a: let(stats(a), lambda b: let(moments(b), p_values)))


def _of_kind(k: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"))


def _scanned(rows: DataFrame, key: str, battery: Battery) -> DataFrame:
    """``key``, ``text``, ``base``: array of (start, kind, end), and ``tested``: candidates outside base spans."""
    text = F.col("text")
    base = F.concat(*[
        F.transform(matches(text, pattern, hint, group, least), _of_kind(k)) for k, (hint, pattern, group, least) in enumerate(KINDS.values())])
    found = rows.select(key, "text", F.sort_array(base).alias("base"), matches(text, TOKEN, "[A-Za-z0-9+/_-]{16}").alias("tokens"))
    # Without let, the optimiser may move the making of "base" into the loop over tokens.
    mixed = let(F.col("base"), lambda base: F.filter("tokens", lambda t: t["value"].rlike("[0-9]") & t["value"].rlike("[A-Za-z]")
                                                     & ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))
    return found.select(key, "text", "base", F.transform(mixed, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), tested(t["value"]).alias("p"))).alias("tested"))


def _stratum(p: Column, battery: Battery) -> Column:
    return p["code"] * (len(battery.lengths) + 1) + sum(((p["n"] >= edge).cast("int") for edge in battery.lengths), F.lit(0))


def _stepped(counts: np.ndarray, rate: float, per: int) -> int:
    """The bin of the largest p-values that the Benjamini-Hochberg step rejects; past the last if none. Bin k starts at 10 ** (-k / per)."""
    found = counts[::-1].cumsum()[::-1]
    passed = np.flatnonzero((found > 0) & (10.0 ** (-np.arange(len(counts)) / per) <= rate * found / max(1, found[0])))
    return int(passed[0]) if len(passed) else len(counts)


def thresholds(rows: DataFrame, battery: Battery) -> dict[int, tuple[float, float]]:
    """Of each encoding and class of lengths: the randomness p-value from which a token may be random, and the largest that discovers it.

    From a histogram of at most (strata x bins of both) cells. A bin's larger end stands for its p-values,
    which keeps the rates below what was asked for.
    """
    p = _scanned(rows, "doc_id", battery).select(F.explode("tested.p").alias("p"))

    def binned(value: Column, least: float) -> Column:
        return F.least(F.floor(-F.log10(F.greatest(value, F.lit(least))) * battery.steps), F.lit(battery.steps * battery.powers)).cast("int")

    # A rejection lies below the rate asked for, so larger randomness p-values share a bin.
    low = F.when(F.col("p.random") >= battery.random, 0).otherwise(binned(F.col("p.random"), 1e-30))
    bins = p.select(_stratum(F.col("p"), battery).alias("stratum"), low.alias("low"), binned(F.col("p.language"), 1e-30).alias("edge")) \
        .groupBy("stratum", "low", "edge").count().toArrow()
    stratum, low, edge, count = (bins.column(c).to_numpy() for c in ("stratum", "low", "edge", "count"))
    size, out = battery.steps * battery.powers + 1, {}
    for s in np.unique(stratum).tolist():
        of = stratum == s
        cut = _stepped(np.bincount(low[of], count[of], size), battery.random, battery.steps)
        left = of & (low < cut)
        at = _stepped(np.bincount(edge[left], count[left], size), battery.rate, battery.steps)
        if at < size:
            out[s] = (10.0 ** (-cut / battery.steps) if cut < size else 0.0, 10.0 ** (-at / battery.steps))
    return out


def _spans(rows: DataFrame, key: str, battery: Battery) -> DataFrame:
    """``key``, ``text``, ``base`` and ``spans``, all spans by start and kind."""
    limits = thresholds(rows, battery)

    def discovered(t: Column) -> Column:
        stratum = _stratum(t["p"], battery)
        least, most = (F.coalesce(*[F.when(stratum == s, F.lit(v[k])) for s, v in limits.items()], F.lit(other)) for k, other in enumerate((2.0, -1.0)))
        return (t["p"]["random"] > least) & (t["p"]["language"] <= most)

    extra = F.transform(F.filter("tested", discovered), _of_kind(len(KINDS)))
    return _scanned(rows, key, battery).select(key, "text", "base", F.sort_array(F.concat("base", extra)).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "random")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def scan(docs: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """``doc_id``, counts per base kind, ``base_sha256``, ``spans`` and ``n_random`` for each row.

    Places count code points, ends are exclusive. A null text counts as empty and has no spans. Repeated
    rows each get their row; extra columns are left out; an empty table gives an empty result.
    """
    found = _spans(texts(docs), "doc_id", battery)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate((*KINDS, "random"))]
    return found.select("doc_id", *counts[:-1], F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"), counts[-1])


def masked(docs: DataFrame, battery: Battery = Battery(), mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every span of ``text`` replaced by ``mark``; overlapping spans become one.

    A null text stays null. Other columns stay as they are.
    """
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = row.select("row", F.coalesce(F.col("row.text"), F.lit("")).alias("text"))
    found = _spans(rows.withColumn("doc_id", F.lit(0)), "row", battery)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("upto"))

    def cut(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["upto"]
        piece = F.concat(acc["out"], F.substring(F.col("text"), (acc["upto"] + 1).cast("int"), (s["start"] - acc["upto"]).cast("int")), F.lit(mark))
        return F.struct(F.when(fresh, piece).otherwise(acc["out"]).alias("out"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    clean = F.aggregate("spans", start, cut, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["upto"] + 1).cast("int"), F.length("text"))))
    text = F.when(F.col("row.text").isNotNull(), F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
    return found.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
