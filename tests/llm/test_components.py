from txgraph.llm.components import components
from txgraph.session import session_conf


def test_few_labels_keep_few_partitions(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 9)], "a long, b long").repartition(6)
    conf = {"spark__sql__shuffle__partitions": "20", "spark__sql__adaptive__coalescePartitions__enabled": "false"}
    with session_conf(spark, **conf):
        labels = components(edges)
        assert labels.rdd.getNumPartitions() == 1
        assert sorted(map(tuple, labels.collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)]
