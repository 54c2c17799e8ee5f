"""Mixing sources to target weights, in DataFrame functions only.

The budget flows down a tree of domain, language and source: each level deals
its budget to the children by weight, never more than a child's subtree can
give (its tokens times ``max_epochs``); what a short child leaves goes to its
siblings by weight, and only what all siblings cannot take goes back to the
parent's siblings.  Budgets are whole tokens, rounded down.  What a level of
the tree deals is found by sums per parent, so a parent may have any number
of children.

Each leaf then takes whole seeded epochs while its budget lasts, and of the
next epoch the prefix, in that epoch's seeded order, whose tokens still fit.
The prefix is found without ordering a leaf in one task: token sums of 256
hash ranges per leaf give the range where the budget ends, that range is parted
into 256 again, and so once more; only the documents of the last range, about
one in 16 million of the leaf, are summed one by one.

Null language or source is the group 'none'; null or empty texts have no
tokens and are taken with the epoch they fall in.  Rows of equal doc_id stand
together in each epoch's order, by a hash of their text.  An empty table gives
no rows.  Weights missing for a name are 1; a weight of 0 takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import cut

# target weights; any name that is not listed weighs 1
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 2}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 2}
SOURCE_WEIGHTS = {"src1": 3, "src2": 2, "src3": 2}
MAX_EPOCHS = 3
SEED = 17
BROADCAST_LEAVES = 100_000
BROADCAST_PARENTS = 100_000
LEVELS = 3    # times the range where a budget ends is parted
DIGITS = 2    # hexadecimal digits of the place that part it
_BIG = "decimal(38,0)"


def default_domain(source: Column) -> Column:
    """Domain of a source: its trailing number modulo 4, 'none' without one."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(digits == "", "none").otherwise(F.concat(F.lit("d"), (F.try_to_number(digits, F.lit("999999999")) % 4).cast("int")))


def count_tokens(text: Column) -> Column:
    """Words between blanks, tabs and line ends."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \t\n\r]+")), F.lit(0)).cast("long")


def _weight(column: str, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1)
    pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[F.col(column)], F.lit(1))


def _deal(children: DataFrame, parents: DataFrame, parent: list[str], child: str, weights: dict[str, int]) -> DataFrame:
    """``budget`` of each child from its parent's (``parents``: parent, ``given``)
    and its own ``capacity``.

    Children whose share is more than they can give are short; the rest share
    by weight what the short ones leave: budget = level * weight.  The level
    comes by Newton's steps from below, each one sum per parent over all its
    children: a level shows some children short, without these the level is
    higher.  It never falls, and where no further child is short it is right.
    No parent's children meet in one task, however many they are."""
    zero, w, cap = F.lit(0).cast(_BIG), F.col("weight").cast(_BIG), F.col("capacity").cast(_BIG)
    rows = cut(children.withColumn("weight", _weight(child, weights)), "children")
    level = cut(parents.join(rows.groupBy(*parent).agg(F.sum(w).cast(_BIG).alias("w_all")), parent)
                .select(*parent, F.col("given").cast(_BIG).alias("given"), "w_all", zero.alias("c_short"), zero.alias("w_short"),
                        F.lit(True).alias("moved")), "level")
    few = level.count() <= BROADCAST_PARENTS
    short = (F.col("weight") > 0) & (cap * (F.col("w_all") - F.col("w_short")) <= (F.col("given") - F.col("c_short")) * w)
    with_level = lambda: rows.join(F.broadcast(level) if few else level, parent)  # noqa: E731  the level of the last step
    while not level.where("moved").isEmpty():
        found = (with_level().where(F.col("moved") & short).groupBy(*parent)
                 .agg(F.sum(cap).cast(_BIG).alias("c_new"), F.sum(w).cast(_BIG).alias("w_new")))
        # a child that was short stays so: the level does not fall
        level = cut(level.join(found, parent, "left")
                    .select(*parent, "given", "w_all", F.coalesce("c_new", "c_short").alias("c_short"),
                            F.coalesce("w_new", "w_short").alias("w_short"),
                            F.coalesce(F.col("w_new") > F.col("w_short"), F.lit(False)).alias("moved")), "level")
    given = F.expr("((given - c_short) * weight) div nullif(w_all - w_short, 0)").cast("long")
    return (with_level().withColumn("budget", F.when(F.col("weight") <= 0, F.lit(0).cast("long"))
                                    .when(short, F.col("capacity")).otherwise(given))
            .select(*children.columns, "budget"))


def budgets(leaves: DataFrame, budget: Column, max_epochs: int, domain_weights: dict, lang_weights: dict,
            source_weights: dict) -> DataFrame:
    """(domain, lang, source, supply, budget) of every leaf; the tree has one
    row per leaf, whatever the number of documents."""
    leaves = leaves.withColumn("capacity", F.col("supply") * max_epochs)
    root = cut(leaves.groupBy(F.lit(0).alias("root")).agg(F.sum("supply").alias("total")).select("root", budget.cast("long").alias("given")), "root")
    tops = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity")).withColumn("root", F.lit(0))
    tops = _deal(tops, root, ["root"], "domain", domain_weights).select("domain", F.col("budget").alias("given"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    langs = _deal(langs, tops, ["domain"], "lang", lang_weights).select("domain", "lang", F.col("budget").alias("given"))
    return _deal(leaves, langs, ["domain", "lang"], "source", source_weights).drop("capacity")


def _narrowed(rows: DataFrame, leaf: list[str], digits: int) -> DataFrame:
    """Of ``rows`` within each leaf's range ``cut``, with ``below`` tokens before
    it, the part (``digits`` digits of the place) where ``rest`` ends."""
    running = Window.partitionBy(*leaf).orderBy("range")
    return (rows.groupBy(*leaf, "rest", "below", F.substring("place", 1, digits).alias("range"))
            .agg(F.sum("n_tokens").alias("t"))
            .withColumn("upto", F.col("below") + F.sum("t").over(running))
            .where("upto > rest and upto - t <= rest")
            .select(*leaf, F.col("range").alias("cut"), (F.col("upto") - F.col("t")).alias("below")))


def mix(docs: DataFrame, share: tuple[int, int] = (1, 1), max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        domain_weights: dict = DOMAIN_WEIGHTS, lang_weights: dict = LANG_WEIGHTS,
        source_weights: dict = SOURCE_WEIGHTS) -> DataFrame:
    """Selected documents: doc_id, epoch (from 0), domain, lang, source and
    n_tokens, one row per epoch a document is taken in.  The budget is the
    fraction ``share`` (numerator, denominator) of all tokens."""
    leaf = ["domain", "lang", "source"]
    none = F.lit("none")
    narrow = cut(docs.select("doc_id", default_domain(F.coalesce("source", none)).alias("domain"),
                             F.coalesce("lang", none).alias("lang"), F.coalesce("source", none).alias("source"),
                             count_tokens(F.col("text")).alias("n_tokens"),
                             F.xxhash64("text").alias("tie")), "tokens")
    leaves = cut(narrow.groupBy(*leaf).agg(F.sum("n_tokens").alias("supply")), "leaves")
    plan = budgets(leaves, F.expr(f"(cast(total as decimal(38,0)) * {share[0]}) div {share[1]}"), max_epochs,
                   domain_weights, lang_weights, source_weights)
    plan = cut(plan.withColumn("whole", F.when(F.col("supply") > 0, F.expr("budget div supply")).otherwise(0))
               .withColumn("rest", F.col("budget") - F.col("whole") * F.col("supply")), "budgets")
    few = plan.count() <= BROADCAST_LEAVES
    joined = narrow.join(F.broadcast(plan) if few else plan, leaf)
    full = (joined.where("whole > 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))))
    drawn = cut(joined.where("rest > 0").withColumn("epoch", F.col("whole"))
                .withColumn("place", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"),
                                                       F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))), "drawn")
    cuts = plan.where("rest > 0").select(*leaf, F.lit("").alias("cut"), F.lit(0).cast("long").alias("below"))
    near = lambda: drawn.join(F.broadcast(cuts) if few else cuts, leaf)  # noqa: E731  one row per leaf
    for level in range(LEVELS):
        cuts = cut(_narrowed(near().where(F.col("place").startswith(F.col("cut"))), leaf, (level + 1) * DIGITS), "cuts")
    placed = near().withColumn("range", F.substring("place", 1, LEVELS * DIGITS))
    inside = placed.where("range < cut")
    order = (Window.partitionBy(*leaf).orderBy("place", "doc_id", "tie")
             .rowsBetween(Window.unboundedPreceding, 0))
    edge = (placed.where("range = cut")
            .withColumn("run", F.sum("n_tokens").over(order)).where("below + run <= rest"))
    cols = ["doc_id", F.col("epoch").cast("int").alias("epoch"), *leaf, "n_tokens"]
    return full.select(*cols).unionByName(inside.select(*cols)).unionByName(edge.select(*cols))


def oracle_sql(share: tuple[int, int] = (1, 1), max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """The same with plain windows, for rows of distinct doc_id."""
    def case(column, weights):
        return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END" if weights else "1"

    def deal(name, source, parent, child, weights):
        return f"""
{name}_w AS (SELECT *, {case(child, weights)} AS w FROM ({source})),
{name}_r AS (SELECT *, CASE WHEN w > 0 THEN capacity::DOUBLE / w END AS ratio FROM {name}_w),
{name}_s AS (SELECT *, sum(w) OVER (PARTITION BY {parent}) AS w_all,
    coalesce(sum(w) OVER o, 0) AS w_before, coalesce(sum(CASE WHEN w > 0 THEN capacity ELSE 0 END) OVER o, 0) AS c_before
  FROM {name}_r WINDOW o AS (PARTITION BY {parent} ORDER BY ratio NULLS LAST, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_t AS (SELECT *, w > 0 AND capacity::HUGEINT * (w_all - w_before) <= (given - c_before)::HUGEINT * w AS short FROM {name}_s),
{name}_u AS (SELECT *, sum(CASE WHEN short THEN capacity ELSE 0 END) OVER (PARTITION BY {parent}) AS c_short,
    sum(CASE WHEN short THEN w ELSE 0 END) OVER (PARTITION BY {parent}) AS w_short FROM {name}_t),
{name} AS (SELECT * EXCLUDE (ratio, w_all, w_before, c_before, short, c_short, w_short, w, given),
    (CASE WHEN w <= 0 THEN 0 WHEN short THEN capacity ELSE ((given - c_short)::HUGEINT * w) // nullif(w_all - w_short, 0) END)::BIGINT AS budget
  FROM {name}_u)"""

    leaf = "domain, lang, source"
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    coalesce('d' || (nullif(regexp_extract(coalesce(source, 'none'), '([0-9]{{1,9}})$', 1), '')::BIGINT % 4), 'none') AS domain,
    coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0)::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT {leaf}, sum(n_tokens)::BIGINT AS supply, (sum(n_tokens) * {max_epochs})::BIGINT AS capacity FROM d GROUP BY ALL),
{deal("tops", f"SELECT domain, 0 AS root, sum(capacity)::BIGINT AS capacity, (SELECT (sum(supply) * {share[0]}) // {share[1]} FROM leaves)::BIGINT AS given FROM leaves GROUP BY ALL", "root", "domain", DOMAIN_WEIGHTS)},
{deal("langs", "SELECT l.domain, l.lang, sum(l.capacity)::BIGINT AS capacity, any_value(t.budget) AS given FROM leaves l JOIN tops t USING (domain) GROUP BY ALL", "domain", "lang", LANG_WEIGHTS)},
{deal("ends", "SELECT l.*, g.budget AS given FROM leaves l JOIN langs g USING (domain, lang)", "domain, lang", "source", SOURCE_WEIGHTS)},
plan AS (SELECT {leaf}, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS whole,
    budget - CASE WHEN supply > 0 THEN budget // supply ELSE 0 END * supply AS rest FROM ends),
j AS (SELECT d.*, plan.whole, plan.rest FROM d JOIN plan USING ({leaf})),
p AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {leaf} ORDER BY md5('{seed}|' || whole || '|' || doc_id), doc_id
    ROWS UNBOUNDED PRECEDING) AS run FROM j WHERE rest > 0)
SELECT doc_id, epoch::INTEGER AS epoch, {leaf}, n_tokens FROM (SELECT *, unnest(range(0, whole)) AS epoch FROM j WHERE whole > 0)
UNION ALL SELECT doc_id, whole::INTEGER, {leaf}, n_tokens FROM p WHERE run <= rest
"""
