import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from llm.helpers import SCHEMA, empty, messy, rows
from pyspark.sql import functions as F

from fieldlight.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|[sS]ecret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def texts():
    rng = random.Random(0)
    pieces = ["token=abc", "token=token:abcdefgh", "API_KEY : 'Zx9+/=_-.aa'", "apikey=\"short", "password = hunter22", "PassWd:'", "secret==abcdefg", "AKIA" + "Q7" * 9, "AKIAABC AKIA" + "Z" * 16, "AKIAAKIA" + "9" * 20,
              "0123456789abcdef01234567", "deadbeef" * 5, "abc", "ünï", "\U0001f600", "漢字", "plain words here", "\n", "ſecret=abcdefgh"]
    out = ["".join(rng.choices(pieces, k=rng.randint(1, 12)) if rng.random() < 0.5 else [" ".join(rng.choices(pieces, k=rng.randint(1, 12)))]) for _ in range(150)]
    return out + [" ".join(["token=abcdef12"] * 500), None, ""]


@pytest.fixture(scope="module")
def found(spark):
    t = texts()
    df = spark.createDataFrame(rows(t), SCHEMA)
    return {r.doc_id: (r.text, [tuple(x) for x in r.secret_spans]) for r in secrets.find_secrets(df).collect()}


def test_base_spans(found):
    for text, spans in found.values():
        assert [s for s in spans if s[1] < 3] == base(text)


def evidence(token, alphabet):
    """Decimal logarithm of the chance by random choice over that in ordinary text, of all characters but the first."""
    kind = lambda c: 0 if c in "0123456789" else 5 if c in "+/-_" else (1 if c.lower() in "aeiou" else 2) + (2 if c.isupper() else 0)
    mass = lambda c: secrets.LETTERS["abcdefghijklmnopqrstuvwxyz".index(c.lower())] if c.isalpha() else 1
    turns = secrets.HEX_TURNS if len(alphabet) == 16 else secrets.TURNS
    kinds, out = {kind(c) for c in alphabet}, 0.0
    if len(alphabet) == 64:
        token = token.replace("-", "+").replace("_", "/")
    for last, c in zip(token, token[1:]):
        turn = turns[kind(last)][kind(c)] / (sum(turns[kind(last)][k] for k in kinds) or 1)
        share = mass(c) / sum(mass(x) for x in alphabet if kind(x) == kind(c))
        out -= math.log10(((1 - secrets.STRAY) * turn * share + secrets.STRAY / len(alphabet)) * len(alphabet))
    return out


def test_battery_against_plain_code(spark):
    """The expressions against the textbook, and against ordinary text's chain, character by character."""
    rng = random.Random(2)
    tokens = ["".join(rng.choices(a, k=n)) for _, a in secrets.ENCODINGS for n in (20, 23, 40) for _ in range(4)]
    tokens += ["a-b_" * 6, "0" * 20, "ab" * 10, "A" * 64, "tableIndexHandlerFactoryBuffer", "AbCdEfGh+/" * 3]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    for r in df.select("t", secrets.battery(F.col("t")).alias("b")).collect():
        code = next(i for i, (p, _) in enumerate(secrets.ENCODINGS) if re.search(p, r.t))
        assert (r.b.size, r.b.code) == (len(r.t), code)
        a = secrets.ENCODINGS[code][1]
        assert r.b.evidence == pytest.approx(evidence(r.t, a))
        v, k, n = [a.index({"-": "+", "_": "/"}.get(c, c) if len(a) == 64 else c) for c in r.t], len(a), len(r.t)
        chi = sum((v.count(x) - n / k) ** 2 / (n / k) for x in range(k))
        z = [max(0.0, (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))]
        up = [2 * x > k - 1 for x in v]
        m1, m0 = sum(up), n - sum(up)
        spread = 2 * m1 * m0 * (2 * m1 * m0 - n) / (n * n * (n - 1))
        z.append((1 + sum(x != y for x, y in zip(up, up[1:])) - (2 * m1 * m0 / n + 1)) / math.sqrt(spread) if spread > 0 else 9.0)
        mean = sum(v) / n
        square = sum((x - mean) ** 2 for x in v)
        z.append((sum((x - mean) * (y - mean) for x, y in zip(v, v[1:])) / square + 1 / n) * math.sqrt(n) if square else 9.0)
        assert r.b.s == pytest.approx(sum(x * x for x in z))


def test_evidence_needed_against_plain_code(spark):
    rng = random.Random(5)
    cands = [(rng.randint(20, 90), min(24, int(rng.expovariate(0.2))) if rng.random() < 0.3 else rng.choice([0, 0, 0, 1, 2])) for _ in range(400)]
    df = spark.createDataFrame([([(0, n, n, x)],) for n, x in cands], "secret_random array<struct<start:int,end:int,size:int,level:int>>")
    t, mean = secrets.evidence_needed(df)
    w = [min(n, 64) / 64 for n, _ in cands]
    assert mean == pytest.approx(sum(w) / len(w))
    p = sorted(10 ** (-x * secrets.STEP) / (y / mean) for (_, x), y in zip(cands, w))
    most = max(i for i, q in enumerate(p, 1) if q <= 0.01 * i / len(p))
    kept = sum(x * secrets.STEP + math.log10(y / mean) >= t - 1e-9 for (_, x), y in zip(cands, w))
    assert kept == most


WORDS = """the table index handler factory buffer column set config id name value request response parse json data stream reader writer file path user account
service manager client server cache memory thread lock queue event message error code status type list map key string number count size max min first last next node tree
graph edge weight search filter sort merge join split format date time zone local remote update delete insert select create build test check verify token image video audio
model train score label batch layer input output shape width height color font style theme button window frame border margin north south river mountain winter summer market""".split()


def identifiers(rng, n):
    """Names as programs and paths have them, 20 to 48 characters long."""
    out = []
    while len(out) < n:
        w = rng.choices(WORDS, k=rng.randint(3, 8))
        style = rng.randrange(7)
        t = ["".join(w), "_".join(w), "-".join(w), "/".join(w), w[0] + "".join(x.title() for x in w[1:]), "_".join(w).upper(), "".join(x.title() for x in w)][style]
        if rng.random() < 0.2:
            t += rng.choice(["", "_"]) + str(rng.randint(0, 9999))
        if 20 <= len(t) <= 48:
            out.append(t)
    return out


def hits(spark, texts):
    df = spark.createDataFrame(rows(texts), SCHEMA)
    return [any(x.rank == 3 for x in r.secret_spans) for r in secrets.find_secrets(df).orderBy("doc_id").collect()]


def test_false_discoveries_and_recall(spark):
    """Names and words made of English beside random strings of every encoding: few hits are false, and recall by encoding
    and length is as the README says."""
    rng = random.Random(11)
    names = identifiers(rng, 3000)
    cases = [(code, n) for code in range(1, 10) for n in (20, 24, 32, 40, 64)]
    drawn = [("".join(rng.choices(secrets.ENCODINGS[code][1], k=n)), (code, n)) for code, n in cases for _ in range(40)]
    got = hits(spark, names + [t for t, _ in drawn])
    false, true = sum(got[: len(names)]), sum(got[len(names) :])
    recall = {c: sum(g for g, (_, x) in zip(got[len(names) :], drawn) if x == c) / 40 for c in cases}
    assert false <= 0.02 * (false + true)
    assert all(recall[code, n] >= 0.9 for code, n in cases if n >= 32 and code in (3, 4, 6, 7, 8, 9)) and recall[5, 64] >= 0.9 and recall[9, 24] >= 0.6


def test_names_alone_give_no_hits(spark):
    got = hits(spark, identifiers(random.Random(12), 1500))
    assert sum(got) <= 3


@pytest.mark.parametrize(("keys", "others"), [(10, 20_000), (30, 3_000), (400, 1_000)])
def test_recall_and_false_hits_at_shares_of_secrets(spark, keys, others):
    """Keys at 0.05, 1 and 30 per cent of all candidates: base 64 of 32 characters and more are found, and hits are rarely false."""
    rng = random.Random(keys)
    secret = ["".join(rng.choices(secrets.ENCODINGS[9][1], k=rng.choice([32, 40, 48]))) for _ in range(keys)]
    got = hits(spark, identifiers(rng, others) + secret)
    false, true = sum(got[:others]), sum(got[others:])
    assert true >= 0.9 * keys and false <= 0.01 * (false + true)


def test_p_values_hold_under_ordinary_text():
    """Strings of the chain itself: one in R at most has an evidence of log10 R."""
    rng = np.random.default_rng(3)
    for code in (1, 3, 6, 9):
        chars = secrets.ENCODINGS[code][1]
        of, share, turns = (np.array(x) for x in secrets.ordinary_text()[code])
        k = len(chars)
        steps = (1 - secrets.STRAY) * turns.reshape(6, 6)[of][:, of] * share + secrets.STRAY / k
        x = np.empty((20_000, 24), int)
        x[:, 0] = rng.integers(0, k, len(x))
        for i in range(1, 24):
            x[:, i] = (rng.uniform(size=(len(x), 1)) >= np.cumsum(steps, axis=1)[x[:, i - 1]]).sum(axis=1).clip(0, k - 1)
        found = -np.log10(steps[x[:, :-1], x[:, 1:]] * k).sum(axis=1)
        for r in (10, 100, 1000):
            assert (found >= np.log10(r)).mean() <= 1.5 / r


def test_the_tables_hold_random_spans(spark, sf_dir):
    """Some secrets of the documents are upper-case hexadecimal, which no base kind sees."""
    found = [x for r in secrets.op2_secrets(spark, sf_dir.replace("sf0.001", "sf0.01")).collect() for x in r.spans.split(",") if x.startswith("random")]
    assert found


def test_redact(spark):
    df = spark.createDataFrame(rows(["é token=abcdef12 x AKIA" + "A1" * 10, "nothing", None]), SCHEMA)
    got = [r[0] for r in secrets.find_secrets(df).orderBy("doc_id").select(secrets.redact(F.col("text"), F.col("secret_spans"))).collect()]
    assert got == ["é [SECRET] x [SECRET]", "nothing", None]


def test_redact_many_spans(spark):
    rng = random.Random(6)
    cases = []
    for n in (0, 1, 1023, 1024, 1025, 5000, 300_000):
        text = "".join(rng.choices("ab é漢\n😀", k=n))
        spans = sorted((a, rng.randrange(4), min(n, a + rng.randint(1, 30))) for a in (rng.randrange(n) for _ in range(n // 40 if n else 0)))
        cases.append((text, spans))
    df = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(cases)], "i int, text string, found array<struct<start:int,rank:int,end:int>>").repartition(1)
    start = time.perf_counter()
    got = [r[0] for r in df.orderBy("i").select(secrets.redact(F.col("text"), F.col("found"))).collect()]
    assert time.perf_counter() - start < 20
    for (text, spans), value in zip(cases, got):
        out, at = "", 0
        for a, _, b in spans:
            if a >= at:
                out += text[at:a] + secrets.MASK
            at = max(at, b)
        assert value == out + text[at:]


def test_prefix_sums(spark):
    for n in (0, 1, 63, 64, 65, 300):
        a = [(i * 7) % 11 for i in range(n)]
        got = spark.createDataFrame([(a,)], "a array<int>").select(secrets.prefix_sums(F.col("a"))).first()[0]
        assert got == [sum(a[:i]) for i in range(n)]


def test_messy(spark):
    df = messy(spark)
    out = secrets.find_secrets(df).collect()
    assert len(out) == df.count() and all([tuple(s) for s in r.secret_spans if s.rank < 3] == base(r.text) for r in out)
    assert secrets.find_secrets(empty(spark)).collect() == []


def test_query_digests(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in secrets.op2_secrets(spark, sf_dir).collect():
        want = base(text[r.doc_id])
        line = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in want) for k in range(3)]
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == [x for x in line.split(",") if x]
