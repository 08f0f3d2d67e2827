"""Typed, weighted transaction graphs, one per ``graph_id``, as DataFrames.

All windows (hours, batches, weeks) are built and processed in the same job. Nodes carry a
dense number ``node`` (order of first appearance in the graph), so the iterative operators
shuffle two integers per endpoint and not strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, functions as F

from txgraph.functions.scalars import hour_start, micros, node_key
from txgraph.operators.prefix import running
from txgraph.operators.skew import HEAVY_MIN, heavy_threshold, lookup_join
from txgraph.session import MAX_BROADCAST_ROWS, freeze, session_conf

# Smallest degree at which a node is treated as a hub in message passing.
HUB_MIN_DEGREE = 100_000

# Largest graph that may be handled as one group inside a task (dense matrices of 2 MB).
KERNEL_NODES = 512

_SIDES = (("device", "device_id"), ("merchant", "merchant_id"))


def with_hourly_graph(tx: DataFrame) -> DataFrame:
    """Tumbling 60-minute windows: ``graph_id`` is the epoch second of the window start."""
    return tx.withColumn("graph_id", hour_start(F.col("event_time")))


def with_window_graph(tx: DataFrame, minutes: int) -> DataFrame:
    """Tumbling windows of any length, aligned to the epoch."""
    length = minutes * 60
    start = F.floor(F.unix_timestamp("event_time") / length) * length
    return tx.withColumn("graph_id", start.cast("bigint"))


def with_weekly_graph(tx: DataFrame) -> DataFrame:
    """One graph per calendar week."""
    return tx.withColumn("graph_id", F.unix_timestamp(F.date_trunc("week", "event_time")))


def edge_table(tx: DataFrame, first_seen: bool = False) -> DataFrame:
    """Undirected account-device and account-merchant edges with count and amount.

    Columns: graph_id, account_id, ntype, other_id, weight, amount [, seen].
    """
    ends = F.array(
        *[
            F.struct(F.lit(ntype).alias("ntype"), F.col(column).alias("other_id"))
            for ntype, column in _SIDES
        ]
    )
    columns = ["graph_id", "account_id", "amount", F.explode(ends).alias("end")]
    aggs = [F.count("*").alias("weight"), F.sum("amount").alias("amount")]
    if first_seen:
        columns.append(F.struct(micros(F.col("event_time")).alias("at"), "tx_id").alias("seen"))
        aggs.append(F.min("seen").alias("seen"))
    return (
        tx.select(*columns)
        .select("*", "end.*")
        .groupBy("graph_id", "account_id", "ntype", "other_id")
        .agg(*aggs)
    )


def keyed_edges(edges: DataFrame) -> DataFrame:
    """The edge table with namespaced node keys: graph_id, src, dst, weight, amount."""
    dst = F.when(
        F.col("ntype") == "device", node_key("device", F.col("other_id"))
    ).otherwise(node_key("merchant", F.col("other_id")))
    return edges.select(
        "graph_id",
        node_key("account", F.col("account_id")).alias("src"),
        dst.alias("dst"),
        "weight",
        "amount",
    )


def endpoint_table(edges: DataFrame) -> DataFrame:
    """Per node: degree, strength (transactions), device and merchant fan-out.

    ``seen`` must be in ``edges`` for the first-appearance key to be in the result.
    """
    has_seen = "seen" in edges.columns

    def end(slot: int, ntype: Column, identifier: Column) -> Column:
        fields = [ntype.alias("ntype"), identifier.alias("id"), F.lit(slot).alias("slot")]
        return F.struct(*fields)

    rank = {name: i + 1 for i, (name, _) in enumerate(_SIDES)}
    account = end(0, F.lit("account"), F.col("account_id"))
    other = F.struct(
        F.col("ntype").alias("ntype"),
        F.col("other_id").alias("id"),
        F.when(F.col("ntype") == "device", rank["device"])
        .otherwise(rank["merchant"])
        .alias("slot"),
    )
    rows = edges.select(
        "graph_id",
        F.col("ntype").alias("side"),
        "weight",
        *(["seen"] if has_seen else []),
        F.explode(F.array(account, other)).alias("end"),
    ).select("*", "end.*")
    from_account = F.col("ntype") == "account"
    aggs = [
        F.count("*").alias("degree"),
        F.sum("weight").alias("strength"),
        F.count_if(from_account & (F.col("side") == "device")).alias("devices"),
        F.count_if(from_account & (F.col("side") == "merchant")).alias("merchants"),
    ]
    if has_seen:
        aggs.append(F.min(F.struct("seen.at", "seen.tx_id", "slot")).alias("seen"))
    return rows.groupBy("graph_id", "ntype", "id").agg(*aggs)


def number_nodes(endpoints: DataFrame) -> DataFrame:
    """Dense 0-based node numbers per graph in order of first appearance."""
    flat = endpoints.select(
        *[c for c in endpoints.columns if c != "seen"], "seen.at", "seen.tx_id", "seen.slot"
    )
    placed = running(flat, ["at", "tx_id", "slot"], ["graph_id"], position="place")
    return placed.withColumn("node", F.col("place") - 1).drop("place", "at", "tx_id", "slot")


def nodes_by_type(vertices: DataFrame, ntype: str) -> DataFrame:
    return vertices.filter(F.col("ntype") == ntype)


def busy_nodes(endpoints: DataFrame, minimum: int = HEAVY_MIN) -> DataFrame | None:
    """Nodes that hold a large share of all transactions: graph_id, ntype, id; None if none.

    ``endpoints`` should be frozen. At most a few times MAX_BROADCAST_ROWS nodes can qualify.
    """
    # Every transaction adds one to the strength of exactly one device.
    rows = endpoints.where("ntype = 'device'").agg(F.sum("strength")).first()[0] or 0
    limit = heavy_threshold(rows, minimum)
    if rows < limit:
        return None
    found = freeze(endpoints.where(F.col("strength") >= limit).select("graph_id", "ntype", "id"))
    return None if found.isEmpty() else found


@dataclass
class TxGraph:
    """Frozen vertex and arc tables of many graphs.

    vertices: graph_id, node, ntype, id, degree, strength, devices, merchants, hub, size
    arcs: graph_id, src, dst, weight, own, down. Both directions of each edge, and one
    ``own`` arc from every node to itself: a node's state then arrives with its messages,
    so that a round refers to the state once and rounds can be chained in one plan.
    ``down`` marks arcs whose source has the higher degree, then the lower number.

    ``arcs`` is kept hash-partitioned by (graph_id, src), as is the output of an aggregate
    by (graph_id, node): a round of messages costs one shuffle. The arcs that leave hubs are
    in ``hub_arcs``, spread evenly; they get the state of their hubs by broadcast.
    """

    spark: SparkSession
    vertices: DataFrame
    arcs: DataFrame
    hub_arcs: DataFrame | None
    graphs: DataFrame
    n_graphs: int
    n_vertices: int
    n_arcs: int
    hubs: DataFrame | None
    busy: DataFrame | None

    @property
    def chain(self) -> int:
        """How many rounds a loop may chain lazily before it cuts lineage."""
        return 1 if self.hubs is not None else 8

    def per_graph(self, table: DataFrame) -> DataFrame:
        """A one-row-per-graph table, broadcast if the number of graphs is within bounds."""
        return F.broadcast(table) if self.n_graphs <= MAX_BROADCAST_ROWS else table

    def split_by_size(self, limit: int) -> tuple[DataFrame | None, DataFrame | None]:
        """Graphs of at most ``limit`` nodes, and the larger ones; None where there are none."""
        small = self.graphs.where(F.col("size") <= limit).select("graph_id", "size")
        large = self.graphs.where(F.col("size") > limit).select("graph_id", "size")
        n_small = small.count()
        return (small if n_small else None), (large if n_small < self.n_graphs else None)

    def split_by_arcs(self, chosen: DataFrame, limit: int) -> tuple[DataFrame | None, DataFrame | None]:
        """Those of the graphs ``chosen`` of at most ``limit`` arcs, and the others, as graph_id, size, arcs; None for none."""
        sized = chosen.select("graph_id").join(self.graphs, "graph_id")
        few, many = sized.where(F.col("arcs") <= limit), sized.where(F.col("arcs") > limit)
        return (None if few.isEmpty() else few), (None if many.isEmpty() else many)

    def small_groups(self, small: DataFrame) -> GroupedData:
        """Arcs of graphs of bounded size, grouped so that each graph is one small group."""
        arcs = self.arcs if self.hub_arcs is None else self.arcs.unionByName(self.hub_arcs)
        rows = arcs.where("not own").join(self.per_graph(small), "graph_id")
        # The work per row is heavy: a set number of partitions is not merged by size.
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.select("graph_id", "src", "dst", "weight", "size")
        return rows.repartition(parts, "graph_id").groupBy("graph_id")

    def edges_once(self, chosen: DataFrame, *columns: str) -> DataFrame:
        """Every edge of the graphs ``chosen`` once, its ends as 32-bit numbers: graph_id, src, dst, ``columns`` of both."""
        arcs = self.arcs if self.hub_arcs is None else self.arcs.unionByName(self.hub_arcs)
        kept = [c for c in columns if c in arcs.columns]
        rows = arcs.where("src < dst").selectExpr("graph_id", "cast(src as int) as src", "cast(dst as int) as dst", *kept)
        return rows.join(self.per_graph(chosen), "graph_id").select("graph_id", "src", "dst", *columns)

    def rounds(self):
        """Settings for iterative plans: the layout is fixed, so re-planning only costs."""
        return session_conf(self.spark, spark__sql__adaptive__enabled="false")

    def place(self, arcs: DataFrame) -> DataFrame:
        """Lay out an arc table by the node it leaves and keep it for the rounds."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return arcs.repartition(parts, "graph_id", "src").persist(StorageLevel.MEMORY_AND_DISK)

    def spread(self, arcs: DataFrame) -> DataFrame:
        """Deal rows out evenly, whatever node they leave."""
        return arcs.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def send(
        self,
        state: DataFrame,
        arcs: DataFrame | None = None,
        hub_arcs: DataFrame | None = None,
        where: str | None = None,
    ) -> DataFrame:
        """Deliver ``state`` (graph_id, node, ...) along the arcs that leave each node.

        Returns the arc columns plus the state columns; ``where`` limits the arcs used.
        """
        if arcs is None:
            arcs, hub_arcs = self.arcs, self.hub_arcs
        sent = state.withColumnRenamed("node", "src")
        on = ["graph_id", "src"]
        if where:
            arcs = arcs.where(where)
        # State rows are unique per node, so hashing them spreads them evenly.
        if self.hubs is None:
            return arcs.join(sent.hint("shuffle_hash"), on)
        hubs = F.broadcast(self.hubs.withColumnRenamed("node", "src"))
        cold = arcs.join(sent.join(hubs, on, "left_anti").hint("shuffle_hash"), on)
        if where:
            hub_arcs = hub_arcs.where(where)
        hot = hub_arcs.join(F.broadcast(sent.join(hubs, on, "left_semi")), on)
        return cold.unionByName(hot)

    def close(self) -> None:
        self.arcs.unpersist()


def build_graph(
    tx: DataFrame, hub_min_degree: int = HUB_MIN_DEGREE, busy_min_rows: int = HEAVY_MIN
) -> TxGraph:
    """Build the graphs of all ``graph_id`` values of ``tx`` at once.

    ``tx`` needs graph_id, tx_id, account_id, device_id, merchant_id, amount, event_time and
    no null identifiers (see ``sources.transactions.split_quarantine``).
    """
    return graph_of_edges(edge_table(tx, first_seen=True), hub_min_degree, busy_min_rows)


def graph_of_edges(
    edges: DataFrame, hub_min_degree: int = HUB_MIN_DEGREE, busy_min_rows: int = HEAVY_MIN
) -> TxGraph:
    """Build the graphs of an edge table with weight and ``seen`` (see :func:`edge_table`)."""
    spark = edges.sparkSession
    edges = freeze(edges.select("graph_id", "account_id", "ntype", "other_id", "weight", "seen"))
    numbered = freeze(number_nodes(endpoint_table(edges)))
    graphs = freeze(
        numbered.groupBy("graph_id").agg(
            F.count("*").alias("size"),
            F.sum("degree").alias("arcs"),
        )
    )
    totals = graphs.agg(F.count("*"), F.sum("size"), F.sum("arcs")).first()
    n_graphs, n_vertices, n_arcs = (int(x or 0) for x in totals)

    hub_degree = heavy_threshold(n_arcs, hub_min_degree)
    # Only look for hubs where the totals allow any.
    hubs = None
    if n_arcs >= hub_degree:
        found = freeze(
            numbered.filter(F.col("degree") >= hub_degree).select("graph_id", "ntype", "id", "node")
        )
        hubs = None if found.isEmpty() else found
    busy = busy_nodes(numbered, busy_min_rows)

    names = numbered.select(
        "graph_id",
        "ntype",
        "id",
        F.struct(
            "node", "degree", (F.col("degree") >= hub_degree).alias("hub")
        ).alias("end"),
    )

    def named(rows: DataFrame, ntype: str, column: str, target: str) -> DataFrame:
        side = names.filter(F.col("ntype") == ntype).select(
            "graph_id", F.col("id").alias(column), F.col("end").alias(target)
        )
        heavy = None
        if hubs is not None:
            heavy = hubs.filter(F.col("ntype") == ntype).select(
                "graph_id", F.col("id").alias(column)
            )
        return lookup_join(rows, side, ["graph_id", column], heavy, how="inner")

    slim = edges.select("graph_id", "account_id", "ntype", "other_id", "weight")
    sided = named(slim, "account", "account_id", "a").drop("account_id")
    pairs = None
    for ntype, _ in _SIDES:
        part = named(sided.filter(F.col("ntype") == ntype), ntype, "other_id", "b")
        part = part.select("graph_id", "a", "b", "weight")
        pairs = part if pairs is None else pairs.unionByName(part)
    arcs = pairs.select(
        "graph_id", "weight", F.expr("explode(array(struct(a as s, b as d), struct(b as s, a as d)))").alias("arc")
    ).selectExpr(
        "graph_id",
        "arc.s.node as src",
        "arc.d.node as dst",
        "weight",
        "arc.s.hub as hub",
        "false as own",
        "arc.s.degree > arc.d.degree"
        " or (arc.s.degree = arc.d.degree and arc.s.node < arc.d.node) as down",
    )
    own = names.selectExpr(
        "graph_id",
        "end.node as src",
        "end.node as dst",
        "0L as weight",
        "end.hub as hub",
        "true as own",
        "false as down",
    )
    frozen = freeze(arcs.unionByName(own))
    sized = numbered.withColumn("hub", F.col("degree") >= hub_degree)
    graph = TxGraph(
        spark=spark,
        vertices=numbered,
        arcs=frozen,
        hub_arcs=None,
        graphs=graphs,
        n_graphs=n_graphs,
        n_vertices=n_vertices,
        n_arcs=n_arcs,
        hubs=None if hubs is None else hubs.select("graph_id", "node"),
        busy=busy,
    )
    if hubs is not None:
        graph.hub_arcs = freeze(graph.spread(frozen.filter("hub").drop("hub")))
    graph.arcs = graph.place(frozen.filter("not hub").drop("hub"))
    graph.vertices = freeze(
        sized.join(graph.per_graph(graphs.select("graph_id", "size")), "graph_id")
    )
    return graph


def graph_sizes(tx: DataFrame) -> DataFrame:
    """Transactions, nodes and edges per graph."""
    edges = edge_table(tx)
    per_edge = edges.groupBy("graph_id").agg(
        F.count("*").alias("n_edges"),
        # Every transaction adds one to the weight of exactly one device edge.
        F.sum(F.when(F.col("ntype") == "device", F.col("weight")).otherwise(0)).alias("n_tx"),
    )
    per_node = (
        endpoint_table(edges).groupBy("graph_id").agg(F.count("*").alias("n_nodes"))
    )
    return per_edge.join(per_node, "graph_id").select("graph_id", "n_tx", "n_nodes", "n_edges")


def vertex_order(tx: DataFrame) -> DataFrame:
    """Node keys with their order of first appearance in the graph."""
    placed = number_nodes(endpoint_table(edge_table(tx, first_seen=True)))
    key = (
        F.when(F.col("ntype") == "account", node_key("account", F.col("id")))
        .when(F.col("ntype") == "device", node_key("device", F.col("id")))
        .otherwise(node_key("merchant", F.col("id")))
    )
    return placed.select("graph_id", key.alias("node"), "ntype", F.col("node").alias("ord"))
