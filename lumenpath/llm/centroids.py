"""Lloyd's clustering by deltas, in exact integers.

Assignments and the global sums of every cluster are kept as tables from round to round. A
round compares a vector only with the centroids that changed in the last update; only a
vector whose own centroid moved away from it is compared with all. Vectors that changed
their owner are then summed as signed transfers (plus for the new owner, minus for the old
one) and added to the kept sums. Vectors are never shuffled: each task adds up its own
transfers, and only these partial sums, one row per cluster and task, are exchanged. The
driver holds the centroids.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.vectors import grid_vectors, matrix
from lumenpath.session import checkpoint, remove, shared_dir

CENTROIDS, ROUNDS, DIMS = 16, 3, 64
#: Sums of products of so small components are exact in doubles.
SMALL = 1 << 22
STATE = "vec_id long, x array<int>, before int, cluster int, distance long"


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (int64) of the rows of ``x`` to each centroid."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < SMALL:
        a, c = x.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] + (c * c).sum(1) - 2 * (a @ c.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def first_owner(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, distance) of every row among all centroids; of equally near ones the smaller number."""
    d = squared(x, centroids)
    own = d.argmin(1)
    return own, d[np.arange(len(x)), own]


def next_owner(x: np.ndarray, own: np.ndarray, was: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, distance) after an update, from the owners and distances before it.

    A centroid that stayed lost to the owner before, so it can only win where the owner moved
    away; every other row is compared with the changed centroids and its owner alone.
    """
    now = was.copy()
    moved = changed[own]
    now[moved] = ((x[moved] - centroids[own[moved]]) ** 2).sum(1)
    away = now > was
    best, least = own.copy(), now
    rows, some = np.flatnonzero(~away), np.flatnonzero(changed)
    if len(rows) and len(some):
        d = squared(x[rows], centroids[some])
        k = d.argmin(1)
        found = d[np.arange(len(rows)), k]
        better = (found < now[rows]) | (found == now[rows]) & (some[k] < own[rows])
        best[rows[better]], least[rows[better]] = some[k[better]], found[better]
    if away.any():
        best[away], least[away] = first_owner(x[away], centroids)
    return best, least


def assigned(state: DataFrame, centroids: np.ndarray, changed: np.ndarray | None) -> DataFrame:
    """The state of the next round: new owners and distances, ``before`` the owner until now. ``changed`` None: the first round."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            if changed is None:
                before, (own, distance) = pa.nulls(len(x), pa.int32()), first_owner(x, centroids)
            else:
                before = batch.column("cluster")
                own, distance = next_owner(x, before.to_numpy().astype(np.int64), batch.column("distance").to_numpy(), centroids, changed)
            made = [batch.column("vec_id"), batch.column("x"), before, pa.array(own, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["vec_id", "x", "before", "cluster", "distance"])

    return state.mapInArrow(run, STATE)


def transfers(state: DataFrame, k: int, dims: int) -> DataFrame:
    """``cluster, at, total``: what each cluster's count (at 0) and sums (at 1 and on) gain and lose through changed owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            rows = np.concatenate([np.ones((len(x), 1), dtype=np.int64), x], 1)
            np.add.at(total, batch.column("cluster").to_numpy(), rows)
            old = batch.column("before")
            left = np.asarray(old.is_valid())
            np.subtract.at(total, old.drop_null().to_numpy(), rows[left])
        touched = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(touched, pa.int32()), pa.array(total[touched].tolist(), pa.list_(pa.int64()))], names=["cluster", "sums"])

    moved = state.where(~F.col("before").eqNullSafe(F.col("cluster"))).select("x", "before", "cluster")
    parts = moved.mapInArrow(run, "cluster int, sums array<long>")
    return parts.select("cluster", F.posexplode("sums").alias("at", "total")).withColumn("total", F.col("total").cast("decimal(38,0)"))


def start_of(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors whose ids' hashes ``sha256("1:<id>")`` are least, in that order; equal ids by their components. Rows without an id start no cluster."""
    name = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id is not null").withColumn("name", name).orderBy("name", "x").limit(k).collect()
    return np.array([r["x"] for r in first], dtype=np.int64)


def cluster(df: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[dict]]:
    """(``vec_id, cluster, distance`` of every kept vector, the final clusters with ``cluster, centroid, n, inertia``).

    Vectors of another length than ``dims``, null ones and those with null or non-finite
    entries are left out; the others become integers ``floor(64 x)``. Each round assigns every
    vector to the nearest centroid (ties: the smaller number), then sets every centroid that
    has vectors to the floor of their mean; after ``rounds`` of them vectors are assigned once
    more. Fewer than ``k`` vectors start fewer clusters; an empty table, or one where no kept
    vector has an id, gives none. Repeated rows count as often as they occur, a null id is kept
    as it is, and extra columns are ignored. Beyond 2**21 a component is an error.
    """
    spark = df.sparkSession
    vectors = grid_vectors(df, id_col, vector_col, dims)
    centroids = start_of(vectors, k)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    k, folder = len(centroids), f"{shared_dir(spark)}/lloyd-{uuid.uuid4().hex}"
    state, changed, sums = vectors, None, None
    for r in range(rounds):
        assigned(state, centroids, changed).write.parquet(f"{folder}/owners-{r}")
        state = spark.read.parquet(f"{folder}/owners-{r}")
        gained = transfers(state, k, dims)
        total = (gained if sums is None else sums.unionByName(gained)).groupBy("cluster", "at").agg(F.sum("total").alias("total"))
        total.write.parquet(f"{folder}/sums-{r}")
        sums = spark.read.parquet(f"{folder}/sums-{r}")
        if r:
            remove(spark, f"{folder}/owners-{r - 1}")
        counts, after = {}, centroids.copy()
        for row in sums.orderBy("at").collect():
            if not row["at"]:
                counts[row["cluster"]] = int(row["total"])
            elif counts[row["cluster"]]:
                after[row["cluster"], row["at"] - 1] = int(row["total"]) // counts[row["cluster"]]
        changed, centroids = (after != centroids).any(1), after
    last = checkpoint(assigned(state, centroids, changed).select("vec_id", "cluster", "distance"))
    remove(spark, folder)
    said = {r["cluster"]: r for r in last.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    none = {"n": 0, "inertia": 0}
    return last, [{"cluster": c, "centroid": centroids[c].tolist(), "n": int(said.get(c, none)["n"]), "inertia": int(said.get(c, none)["inertia"])} for c in range(k)]


def described(df: DataFrame, **parameters) -> DataFrame:
    """``cluster`` with what belongs to a vector's cluster: its inertia, that of all, and a hash of its centroid's components."""
    owners, clusters = cluster(df, **parameters)
    total = sum(c["inertia"] for c in clusters)
    digest = lambda c: hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest()
    rows = [(c["cluster"], c["inertia"], total, digest(c)) for c in clusters]
    facts = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return owners.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
