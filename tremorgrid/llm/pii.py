"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

Spans of the base kinds are seeds. The words around a seed are lexical
patterns. Every other token with a digit or an at sign is a candidate instance
and has patterns too. On the graph of patterns and instances Spark scores in
turns: a pattern by the share of its instances known to be of one kind, an
instance by its patterns. Instances of high confidence are added as spans of
their kind; found ones support further patterns in the next turn.

Only built-in functions are used. Matches are found with regular expressions
whose loops are possessive and which begin only where a match can begin, so
long runs of letters or digits take linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tremorgrid.llm.tables import documents, free_name, text_key
from tremorgrid.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Base patterns; \G admits a match right behind the one before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
NEEDS = {"email": "@", "ip": ".", "phone": "+"}


@dataclass(frozen=True)
class Bootstrap:
    support: int = 4  # distinct known instances that a pattern needs
    unknown: float = 0.5  # how much an instance of no known kind counts against a pattern
    pattern_score: float = 0.7
    instance_score: float = 0.7
    shortest: int = 5  # characters of a candidate: accepted ones are found wherever they stand


def _entries(kind: str, pattern: str) -> Column:
    """The matches of one kind with the texts before them, and one entry more for what stands behind the last."""
    worth = F.col("text").contains(NEEDS[kind]) if kind in NEEDS else F.col("text").rlike("[0-9@]")
    both = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("m"), F.split("text", pattern, -1).alias("g"))
    entry = F.transform(both, lambda e, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), e["m"].alias("found"), e["g"].alias("gap")))
    return F.when(worth, entry).otherwise(F.array().cast("array<struct<kind:string,i:int,found:string,gap:string>>"))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "\\s+"), lambda w: w != "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check: from the right, every second one doubled, its digits added."""
    reverse = F.split(F.reverse(digits), "")
    add = F.transform(F.filter(reverse, lambda x: x != ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        (x.cast("int") * 2) % 10 + F.floor(x.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(add, F.lit(0), lambda a, x: a + x) % 10 == 0


def matches(docs: DataFrame, options: Bootstrap = Bootstrap()) -> DataFrame:
    """All matches with their places: rid, doc_id, text_key, kind, start, end, found, before, behind, ok.

    Every input row has a row at least (kind null where nothing matched).
    ``ok``: a valid base span, or a candidate that touches no base span.
    ``before`` and ``behind`` hold the last two words before the span and the
    first one behind it. They come from the stretches between matches of the
    span's kind and the two matches on either side, so each stretch is read a
    fixed number of times; a word made of more matches than that, without white
    space, is seen from the second one on.
    """
    found = documents(docs.select("doc_id", "text")).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("rid", F.monotonically_increasing_id()).withColumn("text_key", text_key(F.col("text")))
    entries = F.flatten(F.array(*[_entries(k, p) for k, p in [*PATTERNS.items(), ("candidate", CANDIDATE)]]))
    every = found.select("rid", "doc_id", "text_key", F.explode_outer(entries).alias("e")).select("rid", "doc_id", "text_key", "e.*")
    rows = every.withColumn("words", _words(F.col("gap"))).withColumn("n", F.size("words"))
    spaced = lambda side: F.when(F.col("gap").rlike(side), " ").otherwise("")
    rows = rows.withColumn("tail", F.when(F.col("n") > 2, F.concat(F.lit(" "), F.array_join(F.slice("words", -2, 2), " "), spaced("\\s$"))).otherwise(F.col("gap")))
    rows = rows.withColumn("head", F.when(F.col("n") > 1, F.concat(spaced("^\\s"), F.get("words", F.lit(0)), F.lit(" "))).otherwise(F.col("gap")))
    rows = rows.withColumn("gap", F.char_length("gap")).drop("words", "n").repartition("rid")
    along = Window.partitionBy("rid", "kind").orderBy("i")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("found")
    near = lambda c, by: F.coalesce(F.lag(c, by).over(along) if by > 0 else F.lead(c, -by).over(along) if by else F.col(c), F.lit(""))
    rows = rows.withColumn("end", (F.sum("gap").over(upto) + F.sum(size).over(upto)).cast("long"))
    rows = rows.withColumn("before", F.concat(near("found", 2), near("tail", 1), near("found", 1), near("tail", 0)))
    rows = rows.withColumn("behind", F.concat(near("head", -1), near("found", -1), near("head", -2)))
    rows = rows.where("found is not null or i = 0 or i is null").withColumn("start", F.col("end") - size)
    digits = F.regexp_replace("found", "[^0-9]", "")
    parts = F.transform(F.split("found", "\\."), lambda p: F.ltrim(p, F.lit("0")))
    valid = (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", F.forall(parts, lambda p: F.when(F.length(p) > 3, False).when(p == "", True).otherwise(p.cast("int") <= 255)))
        .when(F.col("kind") == "card", F.when((F.length(digits) >= 14) & (F.length(digits) <= 19), _luhn(digits)).otherwise(False))
        .when(F.col("kind") == "phone", (F.length(digits) >= 10) & (F.length(digits) <= 15))
        .when(F.col("kind") == "candidate", size >= options.shortest))
    rows = rows.withColumn("ok", F.col("found").isNotNull() & valid)
    # candidates lose the signs around them
    short = (F.col("kind") == "candidate") & F.col("ok")
    lead = F.regexp_extract("found", "^[^\\p{L}0-9+(]*+", 0)
    rows = rows.withColumn("lead", F.when(short, lead).otherwise("")).withColumn("rest", F.expr("substring(found, char_length(lead) + 1)"))
    core = F.regexp_replace("rest", "[^\\p{L}0-9]++$", "")
    rows = rows.withColumn("core", F.when(short, core).when(F.col("ok"), F.col("found")))
    rows = rows.withColumn("before", F.concat("before", "lead")).withColumn(
        "behind", F.when(short, F.concat(F.expr("substring(rest, char_length(core) + 1)"), "behind")).otherwise(F.col("behind")))
    rows = rows.withColumn("start", F.col("start") + F.char_length("lead")).withColumn("found", F.col("core"))
    rows = rows.withColumn("end", F.when(short, F.col("start") + F.char_length("found")).otherwise(F.col("end")))
    base = F.col("ok") & (F.col("kind") != "candidate")
    order = Window.partitionBy("rid").orderBy("start")
    reach = F.max(F.when(base, F.col("end"))).over(order.rangeBetween(Window.unboundedPreceding, 0))
    back = Window.partitionBy("rid").orderBy(F.desc("start"))  # a frame that only grows
    ahead = F.min(F.when(base, F.col("start"))).over(back.rangeBetween(Window.unboundedPreceding, -1))
    clear = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end"))
    rows = rows.withColumn("clear", clear)
    ok = F.col("ok") & ((F.col("kind") != "candidate") | (F.col("clear") & (F.char_length("found") >= options.shortest)))
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    sides = [F.when(F.col("ok"), F.col(c)).alias(c) for c in ("before", "behind")]
    return rows.select("rid", "doc_id", "text_key", "kind", "start", "end", "found", *sides, "ok")


def edges(rows: DataFrame) -> DataFrame:
    """Distinct (pattern, instance, kind): kind is null for candidates.

    Patterns: the two words before, and one word before with one behind.
    """
    def plain(side: str) -> Column:
        return _words(F.regexp_replace(F.lower(side), "[0-9]", "0"))

    left, right = plain("before"), plain("behind")
    near = rows.where("ok").select(
        F.when(F.col("kind") != "candidate", F.col("kind")).alias("kind"), F.col("found").alias("instance"), left.alias("l"), right.alias("r"))
    patterns = F.array(
        F.when(F.size("l") >= 2, F.concat(F.lit("2:"), F.array_join(F.slice("l", -2, 2), " "))),
        F.when((F.size("l") >= 1) & (F.size("r") >= 1), F.concat(F.lit("1:"), F.element_at("l", -1), F.lit(" _ "), F.element_at("r", 1))))
    return near.select(F.explode(patterns).alias("pattern"), "instance", "kind").where("pattern is not null").groupBy("pattern", "instance").agg(F.min("kind").alias("kind"))


def bootstrapped(graph: DataFrame, options: Bootstrap = Bootstrap()) -> DataFrame:
    """(instance, kind, score) of the candidates that are accepted.

    A turn scores patterns of each kind from the instances known so far, then
    instances from their patterns (1 - product of (1 - score)). Ends with a turn
    that finds no instance that was not found before.
    """
    graph = materialize(graph, "pii_graph")
    sizes = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.count("kind").alias("seeds"))
    # a pattern without any seed can still be reached through instances found in an earlier turn
    known = graph.where("kind is not null").select("pattern", "instance", "kind", F.lit(1.0).alias("score"))
    open_edges = graph.where("kind is null").select("pattern", "instance")
    found = seen = None
    while True:
        voices = known if found is None else known.unionByName(open_edges.join(found, "instance").select("pattern", "instance", "kind", "score"))
        votes = voices.groupBy("pattern", "kind").agg(F.sum("score").alias("pos"), F.count(F.lit(1)).alias("n_pos"))
        total = votes.groupBy("pattern").agg(F.sum("n_pos").alias("n_known"))
        against = F.col("n_known") - F.col("n_pos") + options.unknown * (F.col("n") - F.col("n_known")) + 1
        scored = (
            votes.where(F.col("n_pos") >= options.support).join(total, "pattern").join(sizes, "pattern")
            .select("pattern", "kind", (F.col("pos") / (F.col("pos") + against)).alias("score")).where(F.col("score") >= options.pattern_score))
        by_kind = open_edges.join(scored, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))).alias("score"))
        best = by_kind.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b"), F.count(F.lit(1)).alias("kinds"))
        # an instance that patterns of two kinds claim is left alone
        found = materialize(best.where((F.col("kinds") == 1) & (F.col("b.score") >= options.instance_score)).select("instance", F.col("b.kind").alias("kind"), F.col("b.score").alias("score")), "pii_found")
        new = found if seen is None else found.join(seen, "instance", "left_anti")
        if new.isEmpty():
            return found
        seen = found.select("instance") if seen is None else materialize(seen.unionByName(new.select("instance")), "pii_seen")


def personal_data(docs: DataFrame, options: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, text_key, spans): all spans of every input row.

    ``spans``: array of (start, rank, end, kind, base), in code points, end
    exclusive, by start and then by kind. Null and empty texts have none. Rows
    with equal or null ids stay apart (``rid`` numbers rows); other columns are
    ignored; an empty table gives an empty result.
    """
    rows = materialize(matches(documents(docs, id_col, text_col), options), "pii_matches")
    accepted = bootstrapped(edges(rows), options)
    more = rows.where("ok and kind = 'candidate'").join(accepted.select(F.col("instance").alias("found"), F.col("kind").alias("as_kind")), "found")
    every = rows.select("rid", "doc_id", "text_key", F.when(F.col("ok") & (F.col("kind") != "candidate"), F.col("kind")).alias("kind"), "start", "end", F.lit(True).alias("base")).unionByName(
        more.select("rid", "doc_id", "text_key", F.col("as_kind").alias("kind"), "start", "end", F.lit(False).alias("base")))
    rank = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    span = F.when(F.col("kind").isNotNull(), F.struct("start", rank.alias("rank"), "end", "kind", "base"))
    return every.groupBy("rid", "doc_id", "text_key").agg(F.array_sort(F.collect_list(span)).alias("spans"))


BLOCK = 4096  # characters; a piece of a text is put together from blocks instead of being sought from its start


def _piece(blocks: str, start: str, end: str) -> str:
    """SQL for characters ``start`` up to before ``end`` of the text that ``blocks`` make up."""
    first, last = f"cast(({start}) div {BLOCK} as int)", f"cast((({end}) - 1) div {BLOCK} as int)"
    whole = f"array_join(slice({blocks}, {first} + 2, {last} - {first} - 1), '')"
    return (f"case when ({end}) <= ({start}) then '' "
            f"when {first} = {last} then substring({blocks}[{first}], cast(({start}) % {BLOCK} + 1 as int), cast(({end}) - ({start}) as int)) "
            f"else concat(substring({blocks}[{first}], cast(({start}) % {BLOCK} + 1 as int)), {whole}, substring({blocks}[{last}], 1, cast((({end}) - 1) % {BLOCK} + 1 as int))) end")


def masked(docs: DataFrame, options: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; overlapping spans are replaced together, as the first one's kind.

    All columns are kept, whatever their names; null texts stay null.
    """
    found = personal_data(docs, options, id_col, text_col).where("size(spans) > 0")
    # equal rows have equal spans: one list for each id and text is enough
    found = found.groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans"))
    each = found.select("doc_id", "text_key", F.inline("spans"))
    order = Window.partitionBy("doc_id", "text_key").orderBy("start", "rank")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("fresh", (reach.isNull() | (reach <= F.col("start"))).cast("int"))
    each = each.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = each.groupBy("doc_id", "text_key", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "rank")).alias("kind"))
    islands = islands.withColumn("past", F.coalesce(F.lag("end").over(Window.partitionBy("doc_id", "text_key").orderBy("start")), F.lit(0)))
    names = {c: free_name(docs, f"masked_{c}") for c in ("id", "of", "key", "spans", "blocks")}
    spans, blocks = f"`{names['spans']}`", f"`{names['blocks']}`"
    merged = islands.groupBy(F.col("doc_id").alias(names["id"]), F.col("text_key").alias(names["of"])).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "past", "kind"))).alias(names["spans"]))
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.withColumn(names["key"], text_key(F.coalesce(text, F.lit(""))))
    same = (F.col(names["key"]) == F.col(names["of"])) & F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(names["id"]))
    met = keyed.join(merged, same, "left")
    met = met.withColumn(names["blocks"], F.when(F.expr(f"{spans} is not null"), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    pieces = F.expr(f"transform({spans}, s -> concat({_piece(blocks, 's.past', 's.start')}, '[', upper(s.kind), ']'))")
    rest = F.expr(_piece(blocks, f"{spans}[size({spans}) - 1].end", f"{BLOCK} * (size({blocks}) - 1) + char_length({blocks}[size({blocks}) - 1])"))
    clean = F.concat(F.array_join(pieces, ""), rest)
    return met.withColumn(text_col, F.when(F.expr(f"{spans} is null"), F.col(f"`{text_col}`")).otherwise(clean)).select(*[f"`{c}`" for c in docs.columns])
