import hashlib
import random
import zlib
from itertools import groupby

import pytest
from llm.helpers import SCHEMA, empty, messy, rows

from fieldlight.llm import manifest

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """(root, for each node the siblings on the left and right, level by level)."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, grown = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a : a + 16]
            for i in range(len(run)):
                for m in members[a + i]:
                    paths[m].append(("".join(run[:i]), "".join(run[i + 1 :])))
            ups.append(H("".join(run)))
            grown.append([m for x in members[a : a + 16] for m in x])
        nodes, members = ups, grown
    return nodes[0], paths


def brute(table):
    """table: rows of (doc_id, source, lang, n_chars, text)."""
    order = sorted(table, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    trees = [list(g) for _, g in groupby(order, key=lambda r: r[1])]
    climbed = [climb([leaf(r) for r in t]) for t in trees]
    if not trees:
        return []
    root, above = climb([c[0] for c in climbed])
    out = []
    for tree, (subroot, paths), up in zip(trees, climbed, above, strict=True):
        for row, path in zip(tree, paths, strict=True):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            low = None if row[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            folded = leaf((*row[:4], low)) if hit else leaf(row)
            for left, right in path + up:
                folded = H(left + folded + right)
            out.append((row[0], leaf(row), subroot, root, H("".join(a + b for a, b in path + up)), folded, folded == root))
    return out


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in manifest.manifest(df).collect()), key=repr)


def want(df):
    return sorted(brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]), key=repr)


def table(spark, counts, seed=0):
    rng = random.Random(seed)
    source = [s for s, n in counts.items() for _ in range(n)]
    rng.shuffle(source)
    return spark.createDataFrame(rows([f"Text {rng.random()}" for _ in source], source), SCHEMA)


def test_against_brute_force(spark):
    df = table(spark, {"a": 1, "b": 16, "c": 17, None: 300, "é": 2, "Z": 257, "": 3, "B" * 30: 40})
    assert got(df) == want(df)


@pytest.mark.parametrize("height", [1, 2])
def test_many_sweeps(spark, monkeypatch, height):
    """Shards of 16 or 256 leaves, so that trees take several sweeps, and partitions of 100 rows."""
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "ROWS", 100)
    counts = {"a": 700, "b": 256, "c": 257, "d": 1, "e": 16} | {f"s{i:03}": 1 + i % 3 for i in range(40)}
    df = table(spark, counts, 1)
    assert got(df) == want(df)


def test_messy_rows(spark):
    df = messy(spark).withColumnRenamed("key", "tree").withColumnRenamed("node", "digest")
    out = got(df)
    assert out == want(df) and len(out) == df.count()
    assert not all(r[-1] for r in out) or all(r[1] for r in out)


def test_one_row_and_none(spark):
    one = spark.createDataFrame(rows(["Alone"]), SCHEMA)
    (r,) = got(one)
    assert r[1] == r[2] == r[3] and r[4] == H("") and got(one) == want(one)
    assert got(empty(spark)) == []


def test_tampering_shows(spark):
    df = table(spark, {"a": 200, "b": 30}, 2)
    for doc_id, *_, verified in got(df):
        assert verified == (zlib.crc32(str(doc_id).encode()) % 5 != 0)


def test_query(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = manifest.op11_manifest(spark, sf_dir)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=repr) == want(df)
