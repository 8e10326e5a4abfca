"""Secret scans in DataFrame functions only: base patterns and a battery of randomness tests.

Base kinds are regular expressions. The method adds kind `random`: every maximal run of 20 or more
characters of [A-Za-z0-9+/_-] is a candidate. Its encoding is inferred as the smallest alphabet
that holds it (see ENCODINGS). In that encoding the battery takes three z-scores: chi-squared of uniformity, the runs test
about the middle of the alphabet, and the lag-1 serial correlation. Their squares' sum S is small for random strings.

Only candidates that pass the battery go on: their S is not improbable for random strings (REJECT_RANDOM). The hypothesis tested
is "ordinary text": words, identifiers, paths, constants and numbers. Its p-value is a likelihood ratio, which sees at once what the three
tests see one by one, how far frequencies are from uniform, how kinds of characters take turns and how neighbours hang together:
under ordinary text, the chance of a string that random choice favours R times or more is at most 1 / R. So the p-value 1 / R needs no
calibration and holds however small it is, which a corpus with few secrets among many names needs. Ordinary text is a chain of six classes of
characters (see TURNS) with the letters of language; a share STRAY of all characters may be any, so that rare letters weigh little.
In hexadecimal, ordinary text is numbers with few letters.

The p-values of the whole corpus are tested at once with a false-discovery rate of FDR; longer
candidates, where the tests have more power, get more weight (weighted Benjamini-Hochberg). Only a
histogram of p-values by length, of bounded size, goes to the driver. Digits alone have no p-value under 1; see README for
what is found by encoding and length.

Offsets are code points, ends exclusive. Cases: a null or empty text has no span; repeated rows have
equal spans; overlapping spans of different kinds stay side by side; an empty table gives no row;
texts are scanned whole, in about linear time; columns named secret_base, secret_random or secret_spans are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run is maximal whether its least length stands in the pattern or is tested afterwards.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
LEAST_ASSIGN = 6
FDR = 0.01
#: Random strings pass the battery's own test of randomness with all but this probability.
REJECT_RANDOM = 1e-3
#: Letters a to z per 10,000 in language (about the mean of English, French, German and Spanish).
LETTERS = (831, 140, 330, 410, 1500, 120, 150, 320, 730, 40, 60, 460, 250, 770, 640, 210, 60, 660, 740, 710, 390, 110, 90, 20, 80, 60)
#: Chances of the next character's class, after each class: digit, small vowel and consonant, capital vowel and consonant, joint (the other
#: characters of base 64). Language takes turns, names and paths join words.
TURNS = (
    (0.55, 0.04, 0.08, 0.04, 0.09, 0.20),
    (0.03, 0.13, 0.62, 0.02, 0.04, 0.16),
    (0.03, 0.50, 0.27, 0.02, 0.04, 0.14),
    (0.03, 0.05, 0.35, 0.06, 0.38, 0.13),
    (0.03, 0.30, 0.12, 0.25, 0.20, 0.10),
    (0.10, 0.20, 0.40, 0.08, 0.17, 0.05),
)
#: The same in hexadecimal: numbers, in which few letters stand.
HEX_TURNS = ((0.97, 0.01, 0.02, 0.01, 0.02, 0.0), *(((0.60, 0.20, 0.20, 0.20, 0.20, 0.0),) * 5))
#: Share of characters of ordinary text that may be any.
STRAY = 0.05
#: Lengths count up to this in weights and histogram; minus log10 p is counted in steps up to TOP.
LONGEST, STEP, TOP = 64, 0.25, 12.0
_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_"
#: Encodings, smallest first: pattern, and its characters in order (- and _ stand for + and / in base 64).
ENCODINGS = (
    ("^[0-9]+$", _ALPHABET[:10]),
    ("^[0-9a-f]+$", _ALPHABET[:16]),
    ("^[0-9A-F]+$", _ALPHABET[:10] + "ABCDEF"),
    ("^[a-z]+$", _ALPHABET[10:36]),
    ("^[A-Z]+$", _ALPHABET[36:62]),
    ("^[A-Z2-7]+$", _ALPHABET[36:62] + "234567"),
    ("^[a-z0-9]+$", _ALPHABET[:36]),
    ("^[A-Z0-9]+$", _ALPHABET[:10] + _ALPHABET[36:62]),
    ("^[A-Za-z0-9]+$", _ALPHABET[:62]),
    ("", _ALPHABET[:64]),
)
MASK = "[SECRET]"


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def prefix(numbers: Column, merge) -> Column:
    """What merge (a sum or maximum, from 0) gives of all that stands before each element. In blocks, so that long arrays
    cost little more than linear time."""
    block = 64
    fold = lambda a: F.aggregate(a, F.lit(0), merge)

    def with_blocks(a: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(a) - 1) / block).cast("int")), lambda b: fold(F.slice(a, b * block + 1, F.lit(block))))
        bases = let(blocks, lambda s: F.transform(s, lambda _, i: fold(F.slice(s, F.lit(1), i))))
        return let(bases, lambda s: F.transform(a, lambda _, i: merge(F.get(s, F.floor(i / block).cast("int")), fold(F.slice(a, F.floor(i / block).cast("int") * block + 1, F.pmod(i, F.lit(block)))))))

    return let(numbers, lambda a: F.when(F.size(a) > 0, with_blocks(a)).otherwise(F.array().cast("array<int>")))


def prefix_sums(numbers: Column) -> Column:
    return prefix(numbers, lambda s, x: s + x)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches; value is the group's text.
    The pieces between matches, as split() gives them, place the matches."""
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole

    def placed(m: Column) -> Column:
        lengths = F.transform(m, lambda x: F.length(x))
        # The i-th match starts after i + 1 pieces and i matches.
        steps = let(pieces, lambda p: F.transform(lengths, lambda n, i: n + F.get(p, i)))
        before = prefix_sums(steps)
        return let(before, lambda b: let(pieces, lambda p: let(value, lambda v: F.transform(m, lambda x, i: F.struct((F.get(b, i) + F.get(p, i)).alias("start"), (F.get(b, i) + F.get(p, i) + F.length(x)).alias("end"), F.get(v, i).alias("value"))))))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), let(whole, placed)).otherwise(none)


def _sum(a: Column, f) -> Column:
    return F.aggregate(F.transform(a, f), F.lit(0.0), lambda s, x: s + x)


def battery(token: Column) -> Column:
    """(size, code, s, evidence): its length; its encoding's place; the three z-scores' sum of squares; the decimal logarithm of how many times
    likelier it is by random choice than in ordinary text."""
    code = F.lit(len(ENCODINGS) - 1)
    for i, (pattern, _) in reversed(list(enumerate(ENCODINGS[:-1]))):
        code = F.when(token.rlike(pattern), F.lit(i)).otherwise(code)
    alphabet = lambda c: F.get(F.array(*[F.lit(a) for _, a in ENCODINGS]), c)
    number = lambda x: f"{float(x)!r}D"
    array = lambda row: f"array({','.join(map(number, row))})"
    tables = F.expr("array(" + ",".join(f"named_struct('classes', {array(c)}, 'shares', {array(w)}, 'turns', {array(t)})" for c, w, t in ordinary_text()) + ")")

    def tests(x: Column) -> Column:
        v, k = x["v"], x["k"].cast("double")
        n = F.size(v).cast("double")
        pairs = _sum(F.array_distinct(v), lambda c: F.pow(F.size(F.filter(v, lambda y: y == c)).cast("double"), F.lit(2.0)))
        mean = _sum(v, lambda y: y.cast("double")) / n
        z_chi = (k / n * pairs - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)

        def rest(m: Column) -> Column:
            high = _sum(v, lambda y: F.when(y * 2 > k - 1, 1.0).otherwise(0.0))
            runs = 1 + _sum(v, lambda y, i: F.when((i > 0) & ((y * 2 > k - 1) != (F.get(v, i - 1) * 2 > k - 1)), 1.0).otherwise(0.0))
            both = 2 * high * (n - high)
            spread = both * (both - n) / (n * n * (n - 1))
            z_runs = F.when(spread > 0, (runs - 1 - both / n) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(F.lit(9.0))
            square = _sum(v, lambda y: (y - m) * (y - m))
            lag = _sum(v, lambda y, i: F.when(i > 0, (y - m) * (F.get(v, i - 1) - m)).otherwise(0.0))
            z_lag = F.when(square > 0, (lag / F.greatest(square, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
            s = F.pow(F.greatest(z_chi, F.lit(0.0)), F.lit(2.0)) + z_runs * z_runs + z_lag * z_lag
            return F.struct(F.size(v).alias("size"), x["code"].alias("code"), s.alias("s"), let(F.get(tables, x["code"]), ratio).alias("evidence"))

        def ratio(t: Column) -> Column:
            of = lambda i: F.get(t["classes"], F.get(v, i)).cast("int")
            chance = lambda y, i: F.get(t["turns"], of(i - 1) * 6 + of(i)) * F.get(t["shares"], y)
            return -_sum(v, lambda y, i: F.when(i > 0, F.log10(((1 - STRAY) * chance(y, i) + STRAY / k) * k)).otherwise(0.0))

        return let(mean, rest)

    def coded(c: Column) -> Column:
        chars = F.split(F.when(c == len(ENCODINGS) - 1, F.translate(token, "-_", "+/")).otherwise(token), "")
        v = let(alphabet(c), lambda a: F.transform(chars, lambda x: F.instr(a, x) - 1))
        return F.struct(v.alias("v"), F.length(alphabet(c)).alias("k"), c.alias("code"))

    return let(code, lambda c: let(coded(c), tests))


#: S of a random string is chi-squared with three degrees; its quantile by the cube-root rule at REJECT_RANDOM, 3.09 spreads up.
MOST_S = 3 * (1 - 2 / 27 + 3.0902 * (2 / 27) ** 0.5) ** 3


@lru_cache(1)
def ordinary_text() -> list[tuple[list[int], list[float], list[float]]]:
    """By encoding: each character's class and its share of it, and the classes' turns, for classes that the encoding has."""
    out = []
    for _, chars in ENCODINGS:
        of = [0 if c.isdigit() else 5 if not c.isalpha() else 1 + (c.lower() not in "aeiou") + 2 * c.isupper() for c in chars]
        mass = [LETTERS[ord(c.lower()) - 97] if c.isalpha() else 1.0 for c in chars]
        share = [m / sum(x for x, d in zip(mass, of, strict=True) if d == c) for m, c in zip(mass, of, strict=True)]
        turns = HEX_TURNS if len(chars) == 16 else TURNS
        rows = [[p if c in of else 0.0 for c, p in enumerate(row)] for row in turns]
        out.append((of, share, [p / (sum(row) or 1.0) for row in rows for p in row]))
    return out


def candidates(text: Column) -> Column:
    """Array of (start, end, size, level): level steps of minus log10 of the p-value."""
    def levelled(m: Column, b: Column) -> Column:
        good = (b["s"] <= MOST_S) & (b["code"] > 0)
        reached = F.least(F.floor(b["evidence"] / STEP), F.lit(int(TOP / STEP))).cast("int")
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), b["size"].alias("size"), F.when(good, F.greatest(reached, F.lit(0))).otherwise(0).alias("level"))

    return F.transform(matches(text, CANDIDATE), lambda m: let(battery(m["value"]), lambda b: levelled(m, b)))


def weight(size):
    """Before it is divided by the corpus' mean."""
    return np.minimum(size, LONGEST) / LONGEST


def scanned(docs: DataFrame, text: Column) -> DataFrame:
    """docs with secret_base (array of (start, rank, end)) and secret_random (candidates)."""
    text = F.coalesce(text, F.lit(""))
    span = lambda rank: lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"))
    assign = F.transform(F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= LEAST_ASSIGN), span(0))
    access, hexes = F.transform(matches(text, ACCESS), span(1)), F.transform(matches(text, HEX), span(2))
    return docs.withColumns({"secret_base": F.concat(assign, access, hexes), "secret_random": candidates(text)})


def evidence_needed(scan: DataFrame, fdr: float = FDR) -> tuple[float, float]:
    """scan: secret_random. (t, m): a candidate is random text if its evidence, minus log10 p, plus log10(weight / m) is t at
    least; weighted Benjamini-Hochberg over all candidates of the corpus. The histogram has at most 45 x 49 rows."""
    found = scan.select(F.explode("secret_random").alias("c"))
    rows = found.groupBy(F.least("c.size", F.lit(LONGEST)).alias("size"), "c.level").agg(F.count("*").alias("n")).collect()
    if not rows:
        return float("inf"), 1.0
    size, level, n = (np.array([r[k] for r in rows], float) for k in range(3))
    mean = float((weight(size) * n).sum() / n.sum())
    reached = level * STEP + np.log10(weight(size) / mean)  # p is at most 10 ** -this
    order = np.argsort(-reached)
    good = 10.0 ** -reached[order] * n.sum() <= fdr * np.cumsum(n[order])
    return (float(reached[order][good].min()) if good.any() else float("inf")), mean


def spans(needed: tuple[float, float]) -> Column:
    """Array of (start, rank, end) in order, from what scanned() added; rank: the kind's place in KINDS."""
    t, mean = needed
    enough = lambda m: (m["level"] > 0) & (m["level"] * STEP + F.log10(F.least(m["size"], F.lit(LONGEST)) / (LONGEST * mean)) >= t - 1e-9)
    span = lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("rank"), m["end"].alias("end"))
    more = [F.transform(F.filter("secret_random", enough), span)] if np.isfinite(t) else []
    return F.array_sort(F.concat("secret_base", *more))


def find_secrets(docs: DataFrame, fdr: float = FDR, text: Column | None = None, drop_text: bool = False) -> DataFrame:
    """All columns of docs (but text, if it is to be dropped), with secret_spans: array of (start, rank, end). The scan is
    written once; the corpus-wide threshold is read from it."""
    scan = scanned(docs, F.col("text") if text is None else text)
    scan = cut(scan.drop("text") if drop_text else scan, "secrets")
    return scan.withColumn("secret_spans", spans(evidence_needed(scan, fdr))).drop("secret_base", "secret_random")


def redact(text: Column, found: Column) -> Column:
    """The text with each span, or each chain of overlapping spans, replaced by MASK. What stays is put together from
    blocks of the text, so that many spans in a long text cost linear time."""
    size = 1024
    text_blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    block = lambda at: F.floor(at / size).cast("int")

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        of = lambda at: F.coalesce(F.get(blocks, block(at)), F.lit(""))
        inner = F.array_join(F.slice(blocks, block(a) + 2, F.greatest(block(b) - block(a) - 1, F.lit(0))), "")
        across = F.concat(F.substring(of(a), F.pmod(a, F.lit(size)) + 1, F.lit(size)), inner, F.substring(of(b), F.lit(1), F.pmod(b, F.lit(size))))
        return F.when(block(a) == block(b), F.substring(of(a), F.pmod(a, F.lit(size)) + 1, b - a)).otherwise(across)

    def whole(blocks: Column) -> Column:
        before = prefix(F.transform(found, lambda x: x["end"]), lambda s, x: F.greatest(s, x))
        masked = lambda m: F.flatten(F.transform(found, lambda x, i: F.when(x["start"] >= F.get(m, i), F.array(piece(blocks, F.get(m, i), x["start"]), F.lit(MASK))).otherwise(F.array().cast("array<string>"))))
        last = F.aggregate(found, F.lit(0), lambda s, x: F.greatest(s, x["end"]))
        return F.array_join(F.concat(let(before, masked), F.array(let(last, lambda a: piece(blocks, a, F.length(text))))), "")

    return F.when(F.size(found) > 0, let(text_blocks, whole)).otherwise(text)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir).select("doc_id", "text"), drop_text=True)
    names = F.array(*map(F.lit, KINDS))
    shown = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["end"])), ",")
    count = lambda rank: F.size(F.filter("secret_spans", lambda x: x["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(shown(F.filter("secret_spans", lambda x: x["rank"] < 3)), 256).alias("base_sha256"), shown(F.col("secret_spans")).alias("spans"),
    )
