"""Operator 11 against plain trees."""

import hashlib
import zlib

import pytest
from helpers_llm import frame

from tidemark.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """Levels of a tree from its base to one node."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i - i % 16:i - i % 16 + 16]
        out.append((run[:i % 16], run[i % 16 + 1:]))
        i //= 16
    return out


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    whole = climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            steps = path(trees[s], i) + path(whole, k)
            now = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in steps:
                now = h(*left, now, *right)
            out.append((r[0], own, trees[s][-1][0], whole[-1][0], h(*[x for a, z in steps for x in a + z]), now, now == whole[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in merkle.checked(df).collect()), key=str)


def contract(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_odd_rows(docs):
    assert got(docs) == plain(contract(docs))


def test_empty(none):
    out = merkle.checked(none)
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "leaf"]


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257, 700])
def test_sizes(spark, n):
    rows = [(n - i, f"Text {i}") for i in range(n)]
    df = frame(spark, rows).repartition(3)
    assert got(df) == plain(contract(df))


def test_many_passes(spark):
    """Several passes within a hot group and over many groups of one leaf; repeated rows."""
    rows = [(i % 4500, "hot", "en", i % 7, f"Some Text {i % 4500}") for i in range(9000)] + [(i, f"s{i}", None, 1, "A") for i in range(4200)] + [(7, None, None, None, None)] * 40
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    assert got(df) == plain(rows)


def test_place_is_the_completion_order():
    for n in [1, 2, 15, 16, 17, 31, 255, 256, 257, 300, 4096]:
        levels = merkle.levels_of(n)
        base = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
        log = merkle.append_subtree(base, levels)
        tree = climb([x.hex() for x in base])
        assert len(log) == sum(map(len, tree)) and len(tree) == levels + 1
        for level, nodes in enumerate(tree):
            assert [log[merkle.place(level, k, n)].hex() for k in range(len(nodes))] == nodes
