"""Prerequisite order: levels, cycle breaking and exact topological order.

Edges are taken from the strongest to the weakest, and one is kept if and only if it closes no
cycle with those kept before it. So what is left has no cycle, and every edge that went would
close one again. Only edges inside a strong component can go, and components do not concern each
other: each of at most CORE_EDGES edges is worked off in one task of its own, by an incremental
topological order. Of a larger one the stronger half of the edges goes first and the weaker half
meets what it kept; both fall into components again. The result is the same at every bound.
"""

from __future__ import annotations

import heapq
from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.operators.skew import lookup
from lumenpath.session import checkpoint, ship

#: Up to so many edges (some 100 MB in memory) of one component are finished in one task.
CORE_EDGES = 200_000


def cyclic_core(edges: DataFrame) -> DataFrame:
    """Edges left after peeling sources and sinks: empty if and only if the graph has no cycle.

    What has no level lies on a cycle or behind one; of that, what has none against the
    direction of the edges either lies on a cycle or between two. Edges with a null end go.
    """
    ahead = checkpoint(_between(edges, _unlevelled(edges)))
    if ahead.isEmpty():
        return ahead
    return checkpoint(_between(ahead, _unlevelled(ahead.select(F.col("dst").alias("src"), F.col("src").alias("dst")))))


def _unlevelled(edges: DataFrame) -> DataFrame:
    return levels(edges.select("src", "dst")).where("level is null").select("node")


def _between(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    for end in ("src", "dst"):
        edges = edges.join(nodes.select(F.col("node").alias(end)), end, "left_semi")
    return edges


def is_acyclic(edges: DataFrame) -> bool:
    return _unlevelled(edges).isEmpty()


def break_cycles(edges: DataFrame) -> DataFrame:
    """``edges(src, dst, strength)`` without those that close a cycle with stronger ones that stay.

    Equal strengths are ordered by (src, dst), a null strength is the weakest. Self-loops go,
    edges with a null end stay. Of repeated edges all go or stay; the least strength counts.
    An empty table gives an empty result.
    """
    ship(edges.sparkSession)
    looped = edges.where("src = dst").select("src", "dst").distinct()
    once = edges.where("src <> dst").groupBy("src", "dst").agg(F.min("strength").alias("strength"))
    core = cyclic_core(once)
    # Numbered along a global sort: ascending numbers are ascending strength.
    ranked = checkpoint(core.orderBy("strength", "src", "dst").select("src", "dst", F.monotonically_increasing_id().alias("rank"), F.lit(False).alias("kept")))
    closing = _closing(ranked)
    gone = looped.unionAll(ranked.join(closing, "rank", "left_semi").select("src", "dst"))
    return edges.join(gone, ["src", "dst"], "left_anti")


def _closing(edges: DataFrame) -> DataFrame:
    """``rank`` of the edges of ``edges(src, dst, rank, kept)`` that would close a cycle; those marked ``kept`` have none and stay."""
    named = edges
    parts = checkpoint(strong_components(edges.select("src", "dst")))
    for end in ("src", "dst"):
        named = named.join(parts.select(F.col("node").alias(end), F.col("part").alias(f"{end}_part")), end)
    inside = named.where("src_part = dst_part").select("src", "dst", "rank", "kept", F.col("src_part").alias("part"))
    free = F.when(~F.col("kept"), F.col("rank"))
    sizes = checkpoint(inside.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count(free).alias("free"), F.min(free).alias("low"), F.percentile_approx(free, 0.5).alias("mid")))
    small = inside.join(sizes.where(F.col("n") <= CORE_EDGES).select("part"), "part")
    out = checkpoint(small.groupBy("part").applyInPandas(_closing_of_part, "rank long"))
    large = sizes.where((F.col("n") > CORE_EDGES) & (F.col("free") > 0))
    if large.isEmpty():
        return out
    rest = checkpoint(inside.join(large.select("part", "free", F.greatest("mid", F.col("low") + 1).alias("mid")), "part"))
    # The only free edge of a strong component closes a cycle with the kept ones.
    out = out.unionAll(rest.where((F.col("free") == 1) & ~F.col("kept")).select("rank"))
    rest, high = rest.where("free > 1"), F.col("kept") | (F.col("rank") >= F.col("mid"))
    if rest.isEmpty():
        return out
    strong = _closing(rest.where(high).select("src", "dst", "rank", "kept"))
    weak = _closing(checkpoint(rest.join(strong, "rank", "left_anti").select("src", "dst", "rank", high.alias("kept"))))
    return checkpoint(out.unionAll(strong).unionAll(weak))


def _closing_of_part(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["kept", "rank"], ascending=False)
    gone = closing_edges(list(zip(rows["src"], rows["dst"])))
    return pd.DataFrame({"rank": rows["rank"].iloc[gone].astype("int64")})


def closing_edges(edges: list[tuple]) -> list[int]:
    """Positions of the edges that close a cycle with those kept before them.

    A topological order is kept up to date: an edge that follows it costs nothing; one against
    it is searched for from both ends, inside the stretch of the order between them.
    """
    place, kids, parents, gone = {}, defaultdict(list), defaultdict(list), []
    for i, (u, v) in enumerate(edges):
        for node in (u, v):
            place.setdefault(node, len(place))
        if u == v:
            gone.append(i)
            continue
        if place[u] > place[v]:
            found = _both_ways(kids, parents, place, v, u)
            if found is None:
                gone.append(i)
                continue
            ahead, behind = found
            moved = sorted(behind, key=place.get) + sorted(ahead, key=place.get)
            place.update(zip(moved, sorted(place[x] for x in moved)))
        kids[u].append(v)
        parents[v].append(u)
    return gone


def _both_ways(kids: dict, parents: dict, place: dict, first: object, last: object) -> tuple[set, set] | None:
    """What ``first`` leads to and what leads to ``last`` between their places; None if a path joins them."""
    low, high = place[first], place[last]
    ahead, behind, front, back = {first}, {last}, deque([first]), deque([last])
    while front or back:
        forward = bool(front) and (not back or len(ahead) <= len(behind))
        near, seen, met, todo = (kids, ahead, behind, front) if forward else (parents, behind, ahead, back)
        for x in near[todo.popleft()]:
            if x in met:
                return None
            if x not in seen and low < place[x] < high:
                seen.add(x)
                todo.append(x)
    return ahead, behind


def strong_components(edges: DataFrame) -> DataFrame:
    """``node, part`` of the nodes of ``edges(src, dst)`` that lie on a cycle; ``part`` is one node of the strong component.

    Rounds of colouring: every node takes the largest node that leads to it; what leads to
    the owner of a colour inside the colour is a strong component. Rounds grow with the
    length of paths; what is left is finished in one task at CORE_EDGES edges.
    """
    out = None
    ship(edges.sparkSession)
    kind = f"node {dict(edges.dtypes)['src']}, part {dict(edges.dtypes)['src']}"
    left = cyclic_core(edges.where("src <> dst").distinct())
    while True:
        n = left.count()
        if n <= CORE_EDGES:
            rest = left.select("src", "dst").repartition(1).mapInPandas(_parts_of_small, kind)
            return rest if out is None else out.unionAll(rest)
        colour, moved = checkpoint(left.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("colour", F.col("node"))), 1
        while moved:
            near = left.join(colour, left.src == colour.node).groupBy("dst").agg(F.max("colour").alias("near"))
            after = checkpoint(colour.join(near, colour.node == near.dst, "left").select("node", F.col("colour").alias("old"), F.greatest("colour", "near").alias("colour")))
            moved = after.where("colour <> old").count()
            colour = after.select("node", "colour")
        own = checkpoint(left.join(colour.select(F.col("node").alias("src"), F.col("colour").alias("a")), "src").join(colour.select(F.col("node").alias("dst"), F.col("colour").alias("b")), "dst").where("a = b").select("src", "dst", F.col("a").alias("colour")))
        back = front = checkpoint(colour.where("node = colour"))
        while not front.isEmpty():
            found = own.join(front.select(F.col("node").alias("dst")), "dst", "left_semi").select(F.col("src").alias("node"), "colour").distinct()
            front = checkpoint(found.join(back, "node", "left_anti"))
            back = checkpoint(back.unionAll(front))
        sized = back.groupBy("colour").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts = back.join(sized, "colour", "left_semi").select("node", F.col("colour").alias("part"))
        out = parts if out is None else checkpoint(out.unionAll(parts))
        left = own.join(back.select(F.col("node").alias("src")), "src", "left_anti").join(back.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst")
        left = cyclic_core(left)


def _parts_of_small(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [edge for f in frames for edge in zip(f["src"], f["dst"])]
    found = _tarjan(rows)
    if found:
        yield pd.DataFrame({"node": list(found), "part": list(found.values())})


def _tarjan(edges: list[tuple]) -> dict:
    """Node -> one node of its strong component, for components of two nodes or more."""
    kids = defaultdict(list)
    for u, v in edges:
        kids[u].append(v)
    number, low, stack, on, out = {}, {}, [], set(), {}
    for start in list(kids):
        if start in number:
            continue
        number[start] = low[start] = len(number)
        stack.append(start)
        on.add(start)
        path = [(start, iter(kids[start]))]
        while path:
            u, rest = path[-1]
            v = next(rest, None)
            if v is None:
                path.pop()
                if path:
                    low[path[-1][0]] = min(low[path[-1][0]], low[u])
                if low[u] == number[u]:
                    group = [stack.pop()]
                    while group[-1] != u:
                        group.append(stack.pop())
                    on.difference_update(group)
                    if len(group) > 1:
                        out.update(dict.fromkeys(group, u))
            elif v not in number:
                number[v] = low[v] = len(number)
                stack.append(v)
                on.add(v)
                path.append((v, iter(kids.get(v, ()))))
            elif v in on:
                low[u] = min(low[u], number[v])
    return out


def topological_order(nodes: list[str], edges: list[tuple[str, str]]) -> tuple[list[str], list[str]]:
    """(order, rest) of a small set such as the courses of a plan: always the smallest ready node next.

    Edges count only inside the set. ``rest`` holds nodes on a cycle or behind one, in input order.
    """
    inside = dict.fromkeys(nodes)
    need, out = dict.fromkeys(inside, 0), defaultdict(list)
    for s, d in set(edges):
        if s in inside and d in inside and s != d:
            need[d] += 1
            out[s].append(d)
    ready, order = [n for n in inside if not need[n]], []
    heapq.heapify(ready)
    while ready:
        n = heapq.heappop(ready)
        order.append(n)
        for d in out[n]:
            need[d] -= 1
            if not need[d]:
                heapq.heappush(ready, d)
    return order, [n for n in inside if n not in set(order)]


def levels(edges: DataFrame) -> DataFrame:
    """``node, level`` of the nodes of ``edges(src, dst)``: the most edges on a path that ends there.

    Null for nodes on a cycle or behind one. Repeated edges count once, a self-loop is a
    cycle, an edge with a null end names its other end and no more. An empty table gives an
    empty result.

    Rounds of contraction, until CORE_EDGES edges are left for one task. A node with one
    prerequisite left hangs on it by ``level = max(least, level of the prerequisite + steps)``.
    Such rules compose, so chains and trees of any length are drawn together by pointer
    doubling, in as many steps as their length has binary digits; their nodes wait until the
    level they hang on is known. Sources go in the same round. Each round ends a layer of
    what is left: the nodes where chains meet. The result is the same at every bound.
    """
    ship(edges.sparkSession)
    named = edges.select(F.explode(F.array("src", "dst")).alias("node")).where("node is not null").distinct()
    open_nodes = checkpoint(named.withColumn("least", F.lit(0).cast("long")))
    left = checkpoint(edges.where("src is not null and dst is not null").select("src", "dst").distinct().withColumn("steps", F.lit(1).cast("long")))
    hung: list[DataFrame] = []
    done = edges.sparkSession.createDataFrame([], f"node {dict(edges.dtypes)['src']}, level long")
    while left.count() > CORE_EDGES:
        into = left.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("src") == F.col("dst")).alias("looped"), F.min("src").alias("to"), F.max("steps").alias("steps"))
        state = checkpoint(open_nodes.join(into.withColumnRenamed("dst", "node"), "node", "left"))
        ready = state.where("n is null").select("node", F.col("least").alias("level"))
        single = checkpoint(state.where("n = 1 and not looped").select("node", "to", "least", "steps"))
        if ready.isEmpty() and single.isEmpty():
            break
        drawn, lost = _drawn_together(single)
        hung.append(drawn)
        done = checkpoint(done.unionAll(ready).unionAll(lost.select("node", F.lit(None).cast("long"))))
        # Edges into meeting nodes start where their source hangs now, or have a known level.
        meeting = checkpoint(state.where("n > 1 or looped").select("node", "least"))
        kept = left.join(meeting.select(F.col("node").alias("dst")), "dst", "left_semi")
        hangs = drawn.select(F.col("node").alias("src"), "to", F.col("least").alias("more"), F.col("steps").alias("further"))
        kept = lookup(kept, hangs, "src", "left").select("dst", F.coalesce("to", "src").alias("src"), (F.col("steps") + F.coalesce("further", F.lit(0))).alias("steps"), (F.col("steps") + F.col("more")).alias("more"))
        known = ready.withColumnRenamed("node", "src").withColumn("known", F.lit(True)).unionAll(lost.select(F.col("node").alias("src"), F.lit(None).cast("long"), F.lit(True)))
        kept = checkpoint(lookup(kept, known, "src", "left").withColumn("known", F.coalesce("known", F.lit(False))))
        reached = kept.select(F.col("dst").alias("node"), F.greatest("more", F.when(F.col("known"), F.col("level") + F.col("steps"))).alias("at_least")).groupBy("node").agg(F.max("at_least").alias("at_least"))
        open_nodes = checkpoint(meeting.join(reached, "node", "left").select("node", F.greatest("least", "at_least").alias("least")))
        # What waits for a node on a cycle waits for itself.
        start = F.when(F.col("known"), F.col("dst")).otherwise(F.col("src"))
        left = checkpoint(kept.where("not known or level is null").select(start.alias("src"), "dst", "steps").groupBy("src", "dst").agg(F.max("steps").alias("steps")))
    done = done.unionAll(_finished(open_nodes, left))
    while hung:
        drawn, done = hung.pop(), checkpoint(done)
        told = lookup(drawn.withColumnRenamed("node", "waiting"), done.withColumnRenamed("node", "to"), "to")
        done = done.unionAll(told.select("waiting", F.when(F.col("level").isNotNull(), F.greatest("least", F.col("level") + F.col("steps")))))
    return done.select("node", F.col("level").cast("int").alias("level"))


def _drawn_together(single: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``single(node, to, least, steps)`` with every ``to`` outside of it, and the nodes for which there is none: they circle or lead into a circle."""
    going, ended, reach, n = single, single.sparkSession.createDataFrame([], single.schema), 1, single.count()
    while True:
        there = going.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("least").alias("more"), F.col("steps").alias("further"))
        past = ended.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("least").alias("more"), F.col("steps").alias("further"))
        step = checkpoint(lookup(going, there.unionAll(past), "to", "left"))
        ended = checkpoint(ended.unionAll(step.where("next is null").select("node", "to", "least", "steps")))
        going = step.where("next is not null").select("node", F.col("next").alias("to"), F.greatest("least", F.col("more") + F.col("steps")).alias("least"), (F.col("steps") + F.col("further")).alias("steps"))
        reach *= 2
        if going.isEmpty() or reach > 2 * n:
            return ended, going


def _finished(nodes: DataFrame, left: DataFrame) -> DataFrame:
    """``node, level`` of ``nodes(node, least)``; those that an edge of ``left`` leads to in one task if there are at most CORE_EDGES edges, else null."""
    ends = left.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    free = nodes.join(ends, "node", "left_anti").select("node", F.col("least").alias("level"))
    mine = nodes.join(ends, "node", "left_semi")
    if left.count() > CORE_EDGES:
        return free.unionAll(mine.select("node", F.lit(None).cast("long")))
    kind = dict(nodes.dtypes)["node"]
    rows = left.select("src", "dst", "steps").unionAll(mine.select(F.lit(None).cast(kind), "node", "least"))
    return free.unionAll(rows.repartition(1).mapInPandas(_levels_of_small, f"node {kind}, level long"))


def _levels_of_small(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with a null ``src`` give a node's least level."""
    level, need, kids = {}, defaultdict(int), defaultdict(list)
    for f in frames:
        for u, v, steps, named in zip(f["src"], f["dst"], f["steps"], f["src"].isna()):
            if named:
                level[v] = steps
            else:
                need[v] += 1
                kids[u].append((v, steps))
    ready = [node for node in level if not need[node]]
    for u in ready:
        for v, steps in kids[u]:
            level[v] = max(level[v], level[u] + steps)
            need[v] -= 1
            if not need[v]:
                ready.append(v)
    if level:
        yield pd.DataFrame({"node": list(level), "level": pd.array([None if need[node] else level[node] for node in level], dtype="Int64")})
