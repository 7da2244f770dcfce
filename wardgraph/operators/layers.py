"""Matrix layers as rows of cells: (technique_id, tactic, score, ...)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: platforms by domain
PLATFORMS = {
    "enterprise": ("Windows", "Linux", "macOS", "Network", "PRE", "Containers", "Office 365", "SaaS", "Google Workspace", "IaaS", "Azure AD"),
    "mobile": ("Android", "iOS"),
    "ics": ("None",),
}
# fixed values: order of the countermeasure matrix's columns
COLUMNS = ("Model", "Harden", "Detect", "Isolate", "Deceive", "Evict", "Restore")
# fixed values: gradient, versions, layout and selection of a new layer, as the format's reader wants them
COLOURS = ("#ffe766ff", "#ff9558", "#ff6666ff")
VERSIONS = {"attack": "17", "navigator": "5.1.0", "layer": "4.5"}
LAYOUT = {"layout": "side", "aggregateFunction": "average", "showID": False, "showName": True, "showAggregateScores": False, "countUnscored": False, "expandedSubtechniques": "none"}
SELECTION = {"showTacticRowBackground": False, "tacticRowBackground": "#dddddd", "selectTechniquesAcrossTactics": True, "selectSubtechniquesWithParent": False, "selectVisibleTechniques": False}
CELL = ["technique_id", "tactic"]


def domain_of(layer_type: str) -> str:
    return "enterprise" if layer_type == "enterprise-defend" else layer_type


def filter_platforms(cells: DataFrame, chosen: list[str]) -> DataFrame:
    return cells.where(F.arrays_overlap("platforms", F.array(*map(F.lit, chosen))))


def hide_disabled(cells: DataFrame, hide: bool = True) -> DataFrame:
    return cells.where(F.coalesce("enabled", F.lit(True))) if hide else cells


def search(objects: DataFrame, query: str, fields: list[str]) -> DataFrame:
    hit = reduce(lambda a, b: a | b, (F.coalesce(F.contains(F.lower(f), F.lit(query.lower())), F.lit(False)) for f in fields))
    return objects.where(hit)


_TOKEN = re.compile(r"\s*(?:(\d+(?:\.\d+)?)|([A-Za-z_]\w*)|(>=|<=|==|!=|[-+*/()<>?:]))")
_WORDS = {"and", "or", "not", "xor"}


def score_expression(text: str, names: set[str]) -> Column:
    """A user's expression over layer variables as a column: + - * /, comparisons (1 or 0), and, or, xor, not, and
    c ? a : b. Anything else raises ValueError, so no other SQL comes through. A missing score makes null what it decides."""
    tokens, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m or (m[2] and m[2] not in names | _WORDS):
            raise ValueError(f"not allowed in a score expression: {text[at:at + 20]!r}")
        tokens.append(m[0].strip())
        at = m.end()
    tokens.append("")

    def take(*allowed: str) -> str | None:
        return tokens.pop(0) if tokens[0] in allowed else None

    num = lambda c: c.cast("double")
    truth = lambda c: c != 0
    flag = lambda c: c.cast("int").cast("double")

    def atom() -> Column:
        if take("("):
            out = ternary()
            if not take(")"):
                raise ValueError("a bracket is not closed")
            return out
        if take("-"):
            return -atom()
        if take("not"):
            return flag(~truth(atom()))
        t = tokens.pop(0)
        if not t or not (t[0].isdigit() or t in names):
            raise ValueError(f"a value is missing before {t!r}")
        return F.lit(float(t)) if t[0].isdigit() else num(F.col(t))

    def level(below, ops: dict):
        def run() -> Column:
            out = below()
            while op := take(*ops):
                out = ops[op](out, below())
            return out

        return run

    product = level(atom, {"*": lambda a, b: a * b, "/": lambda a, b: F.try_divide(a, b)})
    total = level(product, {"+": lambda a, b: a + b, "-": lambda a, b: a - b})
    compared = level(total, {">": lambda a, b: flag(a > b), "<": lambda a, b: flag(a < b), ">=": lambda a, b: flag(a >= b), "<=": lambda a, b: flag(a <= b), "==": lambda a, b: flag(a == b), "!=": lambda a, b: flag(a != b)})
    both = level(compared, {"and": lambda a, b: flag(truth(a) & truth(b))})
    either = level(both, {"or": lambda a, b: flag(truth(a) | truth(b)), "xor": lambda a, b: flag(truth(a) != truth(b))})

    def ternary() -> Column:
        cond = either()
        if not take("?"):
            return cond
        yes = ternary()
        if not take(":"):
            raise ValueError("a : is missing")
        no = ternary()
        return F.when(cond.isNull(), F.lit(None)).when(truth(cond), yes).otherwise(no)

    out = ternary()
    if tokens[0]:
        raise ValueError(f"not understood from {tokens[0]!r} on")
    return out


def combine(layers: dict[str, DataFrame], expression: str, missing: float | None = None, inherit: dict[str, str] | None = None, of: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Layers by variable name (technique_id, tactic, score) -> one layer whose score is the expression's value; cells
    are those of any layer. missing: what an unscored or absent cell counts as. inherit: columns of annotations and the
    layer that each is taken from, null in cells that this one lacks. Cells of all layers are grouped once, however many layers
    there are; a cell that a layer repeats counts once, with its highest score. of: domain and version of each layer, which must
    be the same."""
    if of and len({of[n] for n in layers}) > 1:
        raise ValueError(f"layers of different domains or versions: {of}")
    inherit = inherit or {}
    named = [df.select(*CELL, F.lit(n).alias("__layer"), F.col("score").cast("double").alias("__score"), *(c for c, source in inherit.items() if source == n)) for n, df in layers.items()]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    scores = [F.max(F.when(F.col("__layer") == n, F.col("__score"))).alias(n) for n in layers]
    full = every.groupBy(*CELL).agg(*scores, *(F.first(c, ignorenulls=True).alias(c) for c in inherit))
    if missing is not None:
        full = full.fillna(missing, list(layers))
    return full.select(*CELL, score_expression(expression, set(layers)).alias("score"), *inherit)


def upgrade_copies(old: DataFrame, new: DataFrame, annotations: list[str], replaced: DataFrame | None = None) -> DataFrame:
    """Cells of the new version with the annotations of the old version's cell of the same technique and tactic. replaced:
    from_id, to_id of techniques that took another's place and get its annotations too, where they have none of their own."""
    own = old.select(*CELL, *annotations, F.lit(0).alias("rank"))
    if replaced is not None:
        moved = old.join(replaced.select(F.col("from_id").alias("technique_id"), "to_id"), "technique_id")
        own = own.union(moved.select(F.col("to_id").alias("technique_id"), "tactic", *annotations, F.lit(1).alias("rank")))
        own = own.groupBy(*CELL).agg(F.min_by(F.struct(*annotations), "rank").alias("a")).select(*CELL, "a.*")
    return new.select(*CELL).join(own.select(*CELL, *annotations), CELL)


def upgrade_diff(old: DataFrame, new: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """technique_id, name twice -> technique_id, state: added, removed, replaced (by the mapping), changed, unchanged."""
    o, n = old.select("technique_id", F.col("name").alias("old_name")), new.select("technique_id", F.col("name").alias("new_name"))
    both = o.withColumn("in_old", F.lit(True)).join(n.withColumn("in_new", F.lit(True)), "technique_id", "full_outer")
    moved = F.lit(False)
    if replaced is not None:
        both = both.join(replaced.select(F.col("from_id").alias("technique_id"), F.lit(True).alias("moved")).distinct(), "technique_id", "left")
        moved = F.coalesce("moved", F.lit(False))
    state = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull() & moved, "replaced").when(F.col("in_new").isNull(), "removed")
    return both.select("technique_id", state.when(F.col("old_name").eqNullSafe(F.col("new_name")), "unchanged").otherwise("changed").alias("state"))


def expand_tacticless(cells: DataFrame, tactics: DataFrame) -> DataFrame:
    """A cell without a tactic stands for every tactic of its technique."""
    every = cells.where("tactic is null").drop("tactic").join(tactics.select(*CELL), "technique_id")
    return cells.where("tactic is not null").unionByName(every)


def select_by_mapping(current: DataFrame, mapped: DataFrame, subtract: bool = False) -> DataFrame:
    mapped = mapped.select("technique_id").distinct()
    return current.join(mapped, "technique_id", "left_anti") if subtract else current.select("technique_id").union(mapped).distinct()


def sort_rank(cells: DataFrame, mode: int) -> DataFrame:
    """rank within a tactic: modes 0, 1 by name, 2, 3 by score, up and down; unscored counts as 0; ties by technique_id."""
    from pyspark.sql import Window

    key = F.col("name") if mode < 2 else F.coalesce("score", F.lit(0))
    order = key.desc() if mode % 2 else key.asc()
    return cells.withColumn("rank", F.row_number().over(Window.partitionBy("tactic").orderBy(order, "technique_id")))


def column_order(c: Column) -> Column:
    """Place of a countermeasure column: 0 and first if unknown."""
    return F.array_position(F.array(*map(F.lit, COLUMNS)), c)


def aggregate_scores(cells: DataFrame, count_unscored: bool = False) -> DataFrame:
    """technique_id, score -> per technique with sub-techniques: average, min, max, sum over it and them. Unscored cells
    are left out, and of the average zeros too, or count as 0."""
    keyed = cells.select(F.substring_index("technique_id", ".", 1).alias("technique_id"), F.contains("technique_id", F.lit(".")).alias("sub"), F.coalesce("score", F.lit(0)).alias("s") if count_unscored else F.col("score").alias("s"))
    mean = F.avg("s") if count_unscored else F.avg(F.when(F.col("s") != 0, F.col("s")))
    out = keyed.groupBy("technique_id").agg(F.bool_or("sub").alias("has"), mean.alias("average"), F.min("s").alias("min"), F.max("s").alias("max"), F.sum("s").alias("sum"))
    return out.where("has").drop("has")


def layer_json(cells: DataFrame, layer_type: str, most: int, name: str = "layer") -> DataFrame:
    """One layer document of version 4.5 as text. Its cells are one list, as the format wants: a layer is as large as
    the technique matrix, not as the vulnerability data."""
    domain = domain_of(layer_type)
    none = F.array().cast("array<string>")
    cell = F.struct(F.col("technique_id").alias("techniqueID"), F.col("tactic"), F.col("score"), F.lit("").alias("color"), F.lit("").alias("comment"), F.lit(True).alias("enabled"), none.alias("metadata"), none.alias("links"), F.lit(False).alias("showSubtechniques"))
    out = cells.agg(F.sort_array(F.collect_list(cell)).alias("techniques"))
    lits = lambda xs: F.array(*map(F.lit, xs))
    fixed = lambda values: [F.lit(v).alias(k) for k, v in values.items()]
    return out.select(
        F.to_json(
            F.struct(
                F.lit(name).alias("name"),
                F.struct(*fixed(VERSIONS)).alias("versions"),
                F.lit(f"{domain}-attack").alias("domain"),
                F.lit("").alias("description"),
                F.struct(lits(PLATFORMS[domain]).alias("platforms")).alias("filters"),
                F.lit(3).alias("sorting"),
                F.struct(*fixed(LAYOUT)).alias("layout"),
                F.lit(False).alias("hideDisabled"),
                F.col("techniques"),
                F.struct(lits(COLOURS).alias("colors"), F.lit(0).alias("minValue"), F.lit(most).alias("maxValue")).alias("gradient"),
                *(none.alias(x) for x in ("legendItems", "metadata", "links")),
                *fixed(SELECTION),
            )
        ).alias("layer")
    )
