import hashlib
from bisect import bisect
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.helpers import SCHEMA, empty, messy, rows

from fieldlight.llm import alignment

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(table):
    """table: (doc_id, text). Whole texts through both libraries, tokens compared one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = alignment.tokenizer_paths()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    letters = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    back = {c: b for b, c in letters.items()}

    def piece(p):
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    aligned = []
    for _, text in table:
        ids_a, ids_b = ([], []) if not text else (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
        bytes_a, bytes_b = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a], [piece(b.id_to_piece(i)) for i in ids_b]
        own = (" " + text).encode() if text else b""
        if b"".join(bytes_a) != own or b"".join(bytes_b) != own:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        where_b = defaultdict(list)
        for j, e in enumerate(ends_b):
            where_b[e].append(j)
        links = [(ids_a[i], ids_b[j]) for i, e in enumerate(ends_a) for j in where_b.get(e, [])]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            k, m = bisect(ends_a, e), bisect(ends_b, e)
            groups.append(f"{','.join(map(str, ids_a[i:k]))}|{','.join(map(str, ids_b[j:m]))}")
            i, j = k, m
        aligned.append((len(ids_a), len(ids_b), groups, links))
    count = Counter(x for *_, links in aligned for x in links)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for (doc_id, _), (n_a, n_b, groups, links) in zip(table, aligned, strict=True):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), digest))
    return sorted(out, key=repr)


def got(df, **more):
    return sorted((tuple(r[c] for c in COLUMNS) for r in alignment.align(df, **more).collect()), key=repr)


TEXTS = [
    "The quick  brown fox   jumps.", "tabs\tand\nlines\n\n  indented \n end ", " leading", "trailing ", " ", "  ", "\n", "é́ ﬁ ½ 漢字 \U0001f600 x 　y", "a mark ▁ inside", "<|endoftext|> <s> </s> <unk> <0x41>",
    "don't we'll they're I'VE", "\x00 zero \x7f\x85", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20, "x  \n   y", "The quick brown fox", "The quick brown fox", None, "",
]


@pytest.mark.parametrize("most_sent", [alignment.MOST_SENT, 0])
def test_against_brute_force(spark, most_sent):
    df = spark.createDataFrame(rows(TEXTS), SCHEMA).repartition(3)
    want = brute(list(enumerate(TEXTS)))
    assert got(df, most_sent=most_sent) == want
    assert sum(r[4] for r in want) > 100 and any(r[5] < r[4] for r in want)


def test_messy_rows_and_none(spark):
    df = messy(spark, n=20).withColumnRenamed("key", "shard")
    assert got(df) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert got(empty(spark)) == [] and got(empty(spark), most_sent=-1) == []


def test_tree_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 2)
    texts = [f"{w} {i % 7} common words here, {w}{i}" for i, w in enumerate("some words of a text to be cut into many tasks for the tree".split() * 4)]
    assert got(spark.createDataFrame(rows(texts), SCHEMA).repartition(9)) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 47, n))
    h = alignment.PerfectHash.unpacked(*alignment.PerfectHash.build(keys).packed())
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 47, 500), keys)
    assert (h.slots(others) < max(len(keys), 1)).all()


def test_perfect_hash_keeps_what_no_level_takes(monkeypatch):
    monkeypatch.setattr(alignment, "LEVELS", 2)
    keys = np.arange(5000) * 7
    h = alignment.PerfectHash.build(keys)
    assert len(h.rest) and sorted(h.slots(keys).tolist()) == list(range(5000))


def test_other_keys_count_nothing():
    keys = np.arange(1, 400, dtype=np.int64) << 32 | 5
    parts = []
    for s in range(alignment.SHARDS):
        own = keys[alignment.shard_of(keys) == s]
        h = alignment.PerfectHash.build(own)
        by_slot = np.empty(len(own), np.int64)
        by_slot[h.slots(own)] = own
        size, bits, rest = h.packed()
        parts.append({"shard": s, "size": size, "bits": bits, "rest": rest, "keys": by_slot.tobytes(), "counts": (by_slot >> 32).tobytes()})
    table = alignment.Lookup(parts)
    assert (table.counts_of(keys) == keys >> 32).all()
    assert (table.counts_of(keys + 1) == 0).all()
    assert table.best(keys, table.counts_of(keys)).tolist() == [k >> 32 == 399 for k in keys.tolist()]


def test_segments_hold_alone():
    """Both tokenizers on segments give what they give on whole texts; else segments would not be used."""
    assert alignment.Aligner(*alignment.tokenizer_paths()).by_segment


def test_query(spark, sf_dir):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = alignment.op13_alignment(spark, sf_dir)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=repr) == brute(table)
