"""The manifest against a plain Merkle tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 8])))
        i //= 8
    return out


def plain(rows, forged):
    """Expected rows; `forged` gives another row in whose place the leaf is taken, or None."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for rows_of in groups.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {k: levels_of([leaf_of(r) for r in groups[k]]) for k in names}
    top = levels_of([trees[k][-1][0] for k in names])
    out = []
    for j, k in enumerate(names):
        for i, row in enumerate(groups[k]):
            path = path_of(trees[k], i) + path_of(top, j)
            folded = leaf_of(forged(row) or row)
            for left, right in path:
                folded = digest(left, folded, right)
            out.append((row[0], leaf_of(row), trees[k][-1][0], top[-1][0], digest(*[a + b for a, b in path]), folded))
    return sorted(map(repr, out))


def built(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    fields = [F.concat(F.col("text"), F.lit("!")) if f == "text" else F.col(f) for f in manifest.FIELDS]
    out = manifest.manifest(docs, F.col("doc_id") % 3 == 0, manifest.leaf(fields))
    return sorted(map(repr, map(tuple, out.collect())))


def forged(row):
    return (*row[:4], row[4] + "!") if row[0] is not None and row[0] % 3 == 0 and row[4] is not None else None


@pytest.mark.parametrize("sizes", [(1,), (0, 2), (8, 9), (512, 513), (64, 65, 1), (1100, 3, 0, 520)])
def test_trees_of_every_shape(spark, sizes):
    """Lone leaves, full and partial runs, one block and several of them; null and long values."""
    rows = []
    for k, n in enumerate(sizes):
        for i in range(n):
            rows.append((1000 * k + 7 * i, None if i % 4 == 0 else "s", None if k == 0 else f"l{k}é", i if i % 5 else None, None if i % 6 == 5 else f"text {i} é😀"))
    assert built(spark, rows) == plain(rows, forged)


def test_many_languages_and_copies(spark):
    """More languages than one block has nodes; repeated rows, null ids and one very long text."""
    rows = [(i, None, f"l{i % 530}", 1, "x") for i in range(700)]
    rows += [(5, None, "l5", 1, "x")] * 9 + [(None, None, "l5", 1, "y"), (None, None, "l5", 1, None), (4, None, "l5", 1, "Ab " * 400_000)]
    assert built(spark, rows) == plain(rows, forged)
