"""Typed query functions over courses: plan validation, conflicts, waivers and comparison."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenpath.functions.text import token_set
from lumenpath.operators.dag import topological_order


@dataclass
class Curriculum:
    """``courses(code, title, ects, prerequisites, external)`` and ``concepts(code, slug, name, kind, pos)``."""

    courses: DataFrame
    concepts: DataFrame

    def codes(self, given: list[str]) -> list[str]:
        """Known codes as they are written, in the order given; an unknown one is an error. Only the rows asked for are fetched."""
        asked = sorted({g.upper() for g in given})
        upper = {r["code"].upper(): r["code"] for r in self.courses.where(F.upper("code").isin(asked)).select("code").collect()}
        for g in given:
            if g.upper() not in upper:
                known = [r["code"] for r in self.courses.select("code").orderBy("code").collect()]
                raise ValueError(f"unknown_course_code: {g!r} is not one of the known courses ({', '.join(known)})")
        return [upper[g.upper()] for g in given]

    def rows(self, codes: list[str]) -> dict:
        return {r["code"]: r for r in self.courses.where(F.col("code").isin(list(codes))).collect()}


METADATA = "courses map<string, struct<ects int, internal_prerequisites array<string>, external_prerequisites array<string>, provenance string>>"


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``code, ects, prerequisites, external`` from a JSON file of course metadata; unknown fields are ignored."""
    rows = spark.read.schema(METADATA).option("multiLine", True).json(path).select(F.explode("courses").alias("code", "m"))
    none = F.array().cast("array<string>")
    return rows.select("code", F.coalesce("m.ects", F.lit(0)).alias("ects"), F.coalesce("m.internal_prerequisites", none).alias("prerequisites"), F.coalesce("m.external_prerequisites", none).alias("external"))


def curriculum(courses: DataFrame, concepts: DataFrame, metadata: DataFrame) -> Curriculum:
    """Serve a graph: ``courses(course_code, title)``, ``concepts(slug, name, kind, courses)`` with an array or
    "|"-joined text of courses, and metadata of every course. Metadata of other courses is ignored; a course
    without any is an error, since its credits would silently be 0. Concepts of unknown courses are left out.
    """
    c = courses.select(F.col("course_code").alias("code"), "title")
    lost = sorted(r["code"] for r in c.join(metadata, "code", "left_anti").collect())
    if lost:
        raise ValueError(f"no metadata for the courses {', '.join(lost)}")
    of = F.col("courses") if dict(concepts.dtypes)["courses"].startswith("array") else F.split("courses", r"\|")
    each = concepts.select("slug", "name", "kind", F.explode(of).alias("code")).join(c.select("code"), "code", "left_semi")
    placed = each.withColumn("pos", F.row_number().over(Window.partitionBy("code").orderBy("slug", "name")))
    return Curriculum(c.join(metadata, "code"), placed)


def load_curriculum(spark: SparkSession, dataset: str, metadata_path: str) -> Curriculum:
    """Serve an export: the CSV folders ``courses`` and ``concepts`` below ``dataset`` and a metadata file."""
    read = lambda name: spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{dataset}/{name}")
    return curriculum(read("courses"), read("concepts"), read_metadata(spark, metadata_path))


def _positive(value, name: str, least: int = 1) -> None:
    if value is not None and value < least:
        raise ValueError(f"{name} must be at least {least}")


def overloaded_terms(plans: DataFrame, credits: Column, cap: float) -> DataFrame:
    """``plan, term, total`` of the terms of ``plans(plan, term, ...)`` whose credits add up to more than ``cap``."""
    return plans.groupBy("plan", "term").agg(F.sum(credits).alias("total")).where(F.col("total") > cap)


def repeated_courses(plans: DataFrame, order: list[str], value: str) -> DataFrame:
    """Entries of ``plans(plan, code, ...)`` that repeat a course, with the entry before's ``value`` as ``before``."""
    w = Window.partitionBy("plan", "code").orderBy(*order)
    return plans.withColumn("before", F.lag(value).over(w)).where("before is not null")


def late_prerequisites(placed: DataFrame, needs: DataFrame) -> DataFrame:
    """``plan, code, term, needs, needs_term``: courses of ``placed(plan, code, term)`` that do not come after what ``needs(code, needs)`` asks for."""
    own = placed.select("plan", "code", "term").join(needs.select("code", "needs"), "code")
    other = placed.select("plan", F.col("code").alias("needs"), F.col("term").alias("needs_term"))
    return own.join(other, ["plan", "needs"]).where("needs_term >= term").select("plan", "code", "term", "needs", "needs_term")


def plan_totals(targets: DataFrame, completed: DataFrame, credits: DataFrame, budget: float) -> DataFrame:
    """``plan, total, over_budget`` of ``targets(plan, code)`` not among ``completed(plan, code)``; repeated targets count again. ``credits(code, ects)``."""
    todo = targets.select("plan", "code").join(completed.select("plan", "code").distinct(), ["plan", "code"], "left_anti")
    total = todo.join(credits.select("code", "ects"), "code").groupBy("plan").agg(F.sum("ects").alias("total"))
    return total.select("plan", "total", (F.col("total") > budget).alias("over_budget"))


def plan_conflicts(plans: DataFrame, courses: DataFrame, cap: int = 15) -> DataFrame:
    """``plan, type, term, courses, detail, ord`` over any number of plans ``plans(plan, pos, code, term)``.

    ``courses(code, ects, prerequisites)``. A repeated course counts its credits each time and
    stands in its last term; ``ord`` is the order in which one plan's conflicts are reported.
    """
    base = plans.select("plan", "pos", "code", "term").join(courses.select("code", "ects", "prerequisites"), "code")
    out = lambda df, kind, names, detail, *order: df.select("plan", F.lit(kind).alias("type"), "term", names.alias("courses"), detail.alias("detail"), F.struct(*[o.cast("long").alias(f"o{i}") for i, o in enumerate(order)]).alias("ord"))
    twice = repeated_courses(base, ["pos"], "term")
    found = out(twice, "duplicate_course", F.array("code"), F.format_string("%s is planned in term %d and in term %d", "code", "before", "term"), F.lit(0), F.col("pos"), F.lit(0))
    placed = base.groupBy("plan", "code").agg(F.min("pos").alias("first"), F.max_by("term", "pos").alias("term"), F.any_value("prerequisites").alias("prerequisites"))
    names = placed.groupBy("plan", "term").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "code"))), lambda x: x["code"]).alias("names"))
    heavy = overloaded_terms(base, F.col("ects"), cap).join(names, ["plan", "term"], "left")
    found = found.unionAll(out(heavy, "credit_overload", F.coalesce("names", F.array().cast("array<string>")), F.format_string(f"%d > {cap}", F.col("total").cast("long")), F.lit(1), F.col("term"), F.lit(0)))
    needs = placed.select("plan", "code", "first", F.posexplode("prerequisites").alias("at", "needs"))
    late = late_prerequisites(placed, needs.select("code", "needs").distinct()).join(needs, ["plan", "code", "needs"])
    return found.unionAll(out(late, "prerequisite_order", F.array("needs", "code"), F.format_string("%s is not before %s", "needs", "code"), F.lit(2), F.col("first"), F.col("at")))


def recommended_orders(targets: DataFrame, courses: DataFrame) -> DataFrame:
    """``plan, ordered, cyclic``: an order to take each plan's ``targets(plan, pos, code)`` in. A plan's few courses are ordered in one task, plans in parallel."""
    kind = dict(targets.dtypes)["plan"]

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        edges = [(p, code) for code, needs in zip(pdf["code"], pdf["prerequisites"]) for p in needs]
        order, rest = topological_order(pdf["code"].tolist(), edges)
        return pd.DataFrame({"plan": [key[0]], "ordered": [order], "cyclic": [rest]})

    rows = targets.select("plan", "pos", "code").join(courses.select("code", "prerequisites"), "code")
    return rows.groupBy("plan").applyInPandas(one, f"plan {kind}, ordered array<string>, cyclic array<string>")


def validate_study_plan(c: Curriculum, targets: list[str], completed: list[str] = (), max_total_ects: int | None = None) -> dict:
    """Missing prerequisites, total credits (repeated targets count again), budget and an order to take them in."""
    if not targets:
        raise ValueError("target courses must not be empty")
    _positive(max_total_ects, "max_total_ects")
    targets, completed = c.codes(list(targets)), c.codes(list(completed)) if completed else []
    spark, info, have = c.courses.sparkSession, c.rows(targets), set(targets) | set(completed)
    wanted = spark.createDataFrame([(0, i, t) for i, t in enumerate(targets)], "plan int, pos int, code string")
    done = spark.createDataFrame([(0, t) for t in completed], "plan int, code string")
    todo = [t for t in targets if t not in completed]
    violations = [{"course": t, "missing": p} for t in todo for p in info[t]["prerequisites"] if p not in have]
    said = recommended_orders(wanted, c.courses).first()
    violations += [{"course": r, "missing": "<cycle>"} for r in said["cyclic"]]
    row = plan_totals(wanted, done, c.courses, max_total_ects if max_total_ects is not None else float("inf")).first()
    total, over = (row["total"], row["over_budget"]) if row else (0, False)
    notes = [{"course": t, "note": n} for t in todo for n in info[t]["external"]]
    return {"valid": not violations and not over, "total_ects": total, "over_budget": over, "violations": violations, "external_notes": notes, "recommended_order": [*said["ordered"], *said["cyclic"]]}


def detect_plan_conflicts(c: Curriculum, plan: list[tuple[str, int]], max_ects_per_term: int = 15) -> dict:
    """Repeated courses, overloaded terms and prerequisites that come too late."""
    if not plan:
        raise ValueError("the plan must not be empty")
    _positive(max_ects_per_term, "max_ects_per_term")
    for _, term in plan:
        _positive(term, "term")
    codes = c.codes([code for code, _ in plan])
    one = c.courses.sparkSession.createDataFrame([(0, i, code, term) for i, (code, (_, term)) in enumerate(zip(codes, plan))], "plan int, pos int, code string, term int")
    conflicts = [{k: r[k] for k in ("type", "term", "courses", "detail")} for r in plan_conflicts(one, c.courses, max_ects_per_term).orderBy("ord").collect()]
    load = overloaded_terms(one.join(c.courses.select("code", "ects"), "code"), F.col("ects"), float("-inf")).orderBy("term").collect()
    return {"ok": not conflicts, "conflicts": conflicts, "ects_by_term": {str(r["term"]): r["total"] for r in load}}


def best_drop(c: Curriculum, plan: list[tuple[str, int]], max_ects_per_term: int = 15) -> dict | None:
    """The course whose removal leaves the fewest conflicts (then the first by code), and what is left; None for a plan without conflicts."""
    if detect_plan_conflicts(c, plan, max_ects_per_term)["ok"]:
        return None
    codes = c.codes([code for code, _ in plan])
    rows = [(drop, i, code, term) for drop in sorted(set(codes)) for i, (code, (_, term)) in enumerate(zip(codes, plan)) if code != drop]
    left = {drop: 0 for drop in set(codes)}
    if rows:
        tried = c.courses.sparkSession.createDataFrame(rows, "plan string, pos int, code string, term int")
        left |= {r["plan"]: r["n"] for r in plan_conflicts(tried, c.courses, max_ects_per_term).groupBy("plan").agg(F.count(F.lit(1)).alias("n")).collect()}
    drop = min(sorted(left), key=lambda k: left[k])
    return {"drop": drop, "left": left[drop]}


def what_if_drop(c: Curriculum, plan: list[tuple[str, int]], course: str, max_ects_per_term: int = 15) -> dict:
    code = c.codes([course])[0]
    rest = [(k, t) for k, t in plan if k.upper() != code.upper()]
    return detect_plan_conflicts(c, rest, max_ects_per_term) if rest else {"ok": True, "conflicts": [], "ects_by_term": {}}


def coverage(concepts: DataFrame, known: DataFrame, key: list[str], name: str = "name") -> DataFrame:
    """``concepts`` with ``covered``: whether the name's token set equals that of a known name. An empty set never matches."""
    k = known.select(F.array_join(token_set(F.col(name)), " ").alias("_k")).where("_k <> ''").distinct()
    c = concepts.withColumn("_t", F.array_join(token_set(F.col(name)), " "))
    return c.join(k, c["_t"] == k["_k"], "left").select(*key, name, F.col("_k").isNotNull().alias("covered"))


def suggest_substitution(c: Curriculum, course: str, known: list[str], max_residual: int = 5) -> dict:
    """Which concepts of a course are known already, and whether few enough remain to waive it."""
    if not known:
        raise ValueError("known concepts must not be empty")
    _positive(max_residual, "max_residual", 0)
    code = c.codes([course])[0]
    spark = c.concepts.sparkSession
    rows = coverage(c.concepts.where(F.col("code") == code), spark.createDataFrame([(k,) for k in known], "name string"), ["pos"]).orderBy("pos").collect()
    covered, residual = [r["name"] for r in rows if r["covered"]], [r["name"] for r in rows if not r["covered"]]
    return {"course": code, "total": len(rows), "covered": covered, "residual": residual, "waivable": len(residual) <= max_residual}


def related_names(a: DataFrame, b: DataFrame, name: str = "name") -> DataFrame:
    """Pairs ``name_a, name_b`` with equal, non-empty token sets; all pairs of equal names count."""
    key = F.array_join(token_set(F.col(name)), " ")
    left = a.select(F.col(name).alias("name_a"), key.alias("k")).where("k <> ''")
    return left.join(b.select(F.col(name).alias("name_b"), key.alias("k")), "k").select("name_a", "name_b")


def kind_counts(concepts: DataFrame, key: str, kind: str = "kind") -> DataFrame:
    """``key, kind, n``: how many concepts of each kind a course has."""
    return concepts.groupBy(key, kind).agg(F.count(F.lit(1)).alias("n"))


def compare_courses(c: Curriculum, a: str, b: str) -> dict:
    """Counts, kinds, related pairs and what only one of two courses has (by name)."""
    a, b = c.codes([a, b])
    info, part = c.rows([a, b]), {x: c.concepts.where(F.col("code") == x) for x in (a, b)}
    kinds = {x: {r["kind"]: r["n"] for r in kind_counts(part[x], "code").collect()} for x in (a, b)}
    pairs = [tuple(r) for r in related_names(part[a], part[b]).orderBy("name_a", "name_b").collect()]
    only = lambda x, y: [r["name"] for r in part[x].join(part[y].select("name"), "name", "left_anti").orderBy("pos").collect()]
    return {"counts": {x: sum(kinds[x].values()) for x in (a, b)}, "kinds": kinds, "related": pairs, "unique_to_a": only(a, b), "unique_to_b": only(b, a), "external": {x: list(info[x]["external"]) for x in (a, b)}}
