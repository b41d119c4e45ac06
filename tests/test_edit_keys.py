"""A pair is judged under its rarest shared key, and no pair is lost by that."""

import itertools
import random

from casegrid.operators import similar


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_every_pair_once(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice("aabbcdé z1") for _ in range(draw.randint(1, 14))) for _ in range(60)]
    texts = sorted({t.strip() for t in texts} - {""})
    # more of one character than there are bits for, and one that stands alone
    texts += ["aaaaaaaab", "aaaaaaaac", "q"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for least in (0.3, 0.55, 0.8):
        got = similar.alike(df, "t", "t", df.withColumnRenamed("t", "n"), "n", least)
        found = [(r.t, r.n) for r in got.select("t", "n").collect()]
        want = {(a, b) for a, b in itertools.product(texts, texts)
                if 1.0 - _distance(a, b) / max(len(a), len(b)) >= least}
        assert set(found) == want
        assert len(found) < 1.2 * len(want)
