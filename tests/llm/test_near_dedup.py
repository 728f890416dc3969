import os
import random

import numpy as np
from pyspark.sql import functions as F

from sluiceway.llm import near_dedup
from sluiceway.llm.stage import discard, written
from tests.llm.conftest import prose


def shingle_set(text):
    words = text.lower().split()
    return set(zip(words, words[1:]))


def least_linked(sets):
    """Brute force: the smallest id that links of at least 80 hundredths reach."""
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_collisions_are_counted_before_texts_are_compared(spark, monkeypatch):
    """Pairs from far below to far above the threshold on similarity: no link is lost, and no pair below the threshold on matches comes to the texts."""
    pick, rows = random.Random(5), []
    for k in range(40):
        words = prose(100 + k, 150).split()
        rows.append((2 * k, " ".join(words)))
        # Each changed word takes two shingles: 8 of 149 give 133 / 165 = 0.806, others 0.3 to 0.97.
        for i in pick.sample(range(1, 149, 2), (8, 1, 16, 30)[k % 4]):
            words[i] = f"n{k}i{i}"
        rows.append((2 * k + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    compared, real = [], near_dedup._confirmed

    def confirmed(pairs, texts):
        compared.extend((r.a, r.b) for r in pairs.collect())
        return real(pairs, texts)

    monkeypatch.setattr(near_dedup, "_confirmed", confirmed)
    got = {r.id: r.component for r in near_dedup.classes(docs).collect()}
    sets = {i: shingle_set(t) for i, t in rows}
    assert got == least_linked(sets)
    signed = docs.select(F.col("doc_id").alias("id"), "text").mapInArrow(near_dedup._signed, "id long, n long, k1 long, k2 long, signature array<long>")
    signature = {r.id: np.array(r.signature) for r in signed.collect()}
    assert compared and all((signature[a] == signature[b]).sum() >= near_dedup.MATCHES for a, b in compared)


def test_matches_in_blocks_are_counted_by_coordinate():
    """Equal values in other coordinates do not count."""
    random_ = np.random.default_rng(1)
    a, b = (random_.integers(0, 4, (n, near_dedup.COORDINATES)) for n in (7, 9))
    b[3] = np.roll(a[2], 1)
    plain = [[sum(x == y for x, y in zip(left, right)) >= near_dedup.MATCHES for left in a.tolist()] for right in b.tolist()]
    assert near_dedup._enough_matches(a, b).tolist() == plain


def test_discarded_tables_are_gone(spark):
    table = written(spark.range(3).repartition(2))
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
    assert table.count() == 3 and os.path.isdir(folder)
    discard(table, table.where("id > 1"))
    assert not os.path.exists(folder)
    discard(table)
