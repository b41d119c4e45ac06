"""A search reads the cases that its panel comes from once."""

from casegrid.operators import forecast as fc


def test_search_reads_its_panel_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = [("a" if i % 2 else "b", 2000 + i // 2, float(i % 3 + 1), float(i % 5)) for i in range(24)]
    df = spark.createDataFrame(rows, "district string, year int, case_count double, odd double")
    train = df.mapInPandas(counted, df.schema)
    fc.grid_search(train, "poisson", {"alpha": (0.1,), "max_iter": (20,)}, ["district", "year"], ["odd"])
    assert read.value == len(rows)
