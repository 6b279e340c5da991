"""The keys of decontamination on their own: recall at the bound, and how many unrelated windows they let through."""

import numpy as np
import pytest

from venuelake.llm import decontaminate
from venuelake.llm.words import Words


@pytest.fixture(scope="module")
def words(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").orderBy("doc_id").limit(300).collect()
    return Words([decontaminate.normalise(r.text.encode()) for r in rows], fold=False).hash


@pytest.mark.parametrize("n", [5, 8, 12, 16, 20, 24, 30, 40, 59, 120])
def test_recall_and_pass_rate(words, n):
    rng = np.random.default_rng(n)
    pick = lambda: int(rng.integers(0, len(words) - 2 * n))
    items, near, other = [], [], []
    for _ in range(300):
        at = pick()
        edited = list(words[at : at + n])
        for _ in range(n // 5):
            i, kind = int(rng.integers(0, len(edited))), rng.integers(0, 3)
            if kind == 0:
                edited[i] = words[pick()]
            elif kind == 1:
                del edited[i]
            else:
                edited.insert(i, words[pick()])
        items.append(words[at : at + n])
        near.append(np.array((edited + list(words[at + n : at + 2 * n]))[:n], np.uint64))
        at = pick()
        other.append(words[at : at + n])
    keys = [decontaminate.sampled(decontaminate.embed(np.concatenate(x), np.arange(300) * n, np.full(300, n)), n) for x in (items, near, other)]
    shared = lambda x, y: ((x == y) & (x != 0)).any(1).mean()
    assert shared(keys[0], keys[1]) >= 0.97 and shared(keys[0], keys[2]) <= 0.08
