from waferlens.sources import partitioned


def test_partitions_with_odd_names_are_listed_and_dropped(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a b", 7), (2, "x=y/z", 7), (3, "it's", 8), (4, "p+q%41", 9)], "id long, k string, n int")
    t = partitioned.PartitionedTable.create(spark, "odd_names", rows.schema, ["k", "n"], str(tmp_path / "t"))
    t.append(rows)
    t.add(k="empty+1", n=1)
    t.add(k="it's", n=9)
    assert sorted(map(tuple, t.empty().collect())) == [("empty+1", 1), ("it's", 9)]
    assert t.drop_empty() == 2 and t.drop_empty() == 0
    assert sorted(map(tuple, t.partitions().collect())) == sorted((r.k, r.n) for r in rows.collect())
    t.refill(rows.filter("n = 7").selectExpr("n", "id + 10 as id", "k"))
    assert sorted(r.id for r in spark.table(t.name).collect()) == [3, 4, 11, 12]
    spark.sql("DROP TABLE odd_names")
