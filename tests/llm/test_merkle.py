"""Merkle manifest against hashing by hand."""

import hashlib
import zlib

import pytest

from plugsites.llm.catalog import ORACLE_SQL, QUERIES
from plugsites.llm.merkle import FANOUT, verified_documents
from tests.oracle import connect, sorted_rows

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, path int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = [*row[:4], text]
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return digest("".join(parts))


def climb(leaves):
    """(root, path of every leaf); a path is a list of (before, after)."""
    paths, own = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for leaf, at in enumerate(own):
            first = at // FANOUT * FANOUT
            run = leaves[first : first + FANOUT]
            paths[leaf].append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
        own = [at // FANOUT for at in own]
        leaves = [digest("".join(leaves[n : n + FANOUT])) for n in range(0, len(leaves), FANOUT)]
    return leaves[0], paths


def by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[4]), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {name: climb([leaf for *_, leaf, _ in sorted(groups[name], key=lambda g: g[:3])]) for name in names}
    root, tops = climb([trees[name][0] for name in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops):
        subroot, paths = trees[name]
        for (*_, leaf, row), path in zip(sorted(groups[name], key=lambda g: g[:3]), paths):
            path, text = path + top, row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            found = leaf_of(row, text)
            for before, after in path:
                found = digest(before + found + after)
            proof = digest("".join(before + after for before, after in path))
            out.append((row[0], leaf, subroot, root, proof, found, found == root))
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(5)
    found = verified_documents(docs)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def rows_of(counts):
    ids = iter(range(100_000))
    return [(next(ids), s, "en", n, f"Text {n} É of {s}") for s, many in counts.items() for n in range(many)]


@pytest.mark.parametrize(
    "rows",
    [
        rows_of({"hot": 300, "b": 17, "c": 16, "one": 1, None: 5, "": 2}),
        rows_of({f"s{n}": 1 + n % 3 for n in range(40)}),
        rows_of({"only": 1}),
        [(n, "a", None, None, None) for n in range(3)] + [(9, "a", "", 0, ""), (None, "a", "x", 1, "Null Id")],
        [(5, "a", "en", 1, "Same Row")] * 20 + [(5, "a", "en", 1, "other Row")],
        [(1, "a", "en", 1, "Very Long " * 200_000), (0, "z", "en", 1, "short")],
    ],
)
def test_equals_hashing_by_hand(spark, rows):
    assert run(spark, rows) == sorted(by_hand(rows), key=repr)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query_equals_sql(spark, folder):
    found = QUERIES["op12_merkle_manifest"](spark, folder)
    expected = connect(folder).sql(ORACLE_SQL["op12_merkle_manifest"])
    rows = sorted_rows(found.collect(), found.columns)
    assert rows == sorted_rows(expected.fetchall(), expected.columns)
    assert 0 < sum(row.verified for row in found.select("verified").collect()) < len(rows)
