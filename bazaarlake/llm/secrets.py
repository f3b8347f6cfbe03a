"""Secret scans through a trigram index; DataFrame functions only.

Every rule is a regular expression. The trigrams that each of its matches must hold follow from the
expression: a Boolean query in disjunctive form, an alternative per literal spelling. The index keeps a
posting (trigram, document) for every trigram that some query names; a rule's candidates are the documents
whose postings intersect to one of its alternatives, and only those are scanned. A rule without mandatory
trigrams scans all documents. Letters are folded for the index, so it only ever admits too much.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as code  # the published opcodes of the standard regular-expression parser
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import store

MAX_SPELLINGS = 64
#: Matches of a text whose positions are summed together.
PART = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count where group ``group`` has at least ``least`` characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The three base rules.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", ASSIGN, 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]+", 0, 32, True),
)
# Further published token formats.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _spellings(items: list) -> list[list[str]]:
    """Alternatives of the literal pieces that each match of the parsed expression holds, a break between pieces as ''."""
    out: list[list[str]] = [[""]]

    def glue(left: list[str], right: list[str]) -> list[str]:
        return [*left[:-1], left[-1] + right[0], *right[1:]]

    for op, arg in items:
        if op is code.LITERAL:
            options = [[chr(arg)]]
        elif op is code.IN and arg[0][0] is code.LITERAL and all(o is code.LITERAL for o, _ in arg) and len(arg) <= 8:
            options = [[chr(value)] for _, value in arg]
        elif op is code.SUBPATTERN:
            options = _spellings(arg[-1])
        elif op is code.BRANCH:
            options = [found for branch in arg[1] for found in _spellings(branch)]
        elif op is code.MAX_REPEAT and arg[0] == 0 and arg[1] == 1 and len(arg[2]) == 1 and arg[2][0][0] is code.LITERAL:
            options = [[""], *_spellings(arg[2])]
        else:
            options = [["", ""]]
        glued = [glue(a, b) for a in out for b in options]
        # Too many spellings: what follows is left out of the query, which only admits more.
        out = glued if len(glued) <= MAX_SPELLINGS else [[*a, ""] for a in out]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of folded trigrams; every match holds all trigrams of one of them. Empty: no mandatory trigram."""
    found = set()
    for pieces in _spellings(list(parser.parse(pattern))):
        text = [p.lower() for p in pieces]
        found.add(frozenset(p[i : i + 3] for p in text for i in range(len(p) - 2)))
    if frozenset() in found:
        return []
    # An alternative that needs more than another is implied by it.
    return sorted((a for a in found if not any(b < a for b in found)), key=sorted)


def postings(docs: DataFrame, key: list[str], text: str, trigrams: list[str]) -> DataFrame:
    """(``trigram``, key): the distinct trigrams of each text, of those that queries name."""
    folded = F.lower(F.col(text))
    held = F.array(*[F.when(folded.contains(t), F.lit(t)) for t in trigrams])
    # The outer form keeps the optimizer from adding a filter that computes the array a second time.
    return docs.select(*key, held.alias("_held")).select(*key, F.explode_outer("_held").alias("trigram")).where("trigram IS NOT NULL")


def candidates(index: DataFrame, key: list[str], queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(key, ``rules``): the rules of which a document's postings intersect to some alternative."""
    spark = index.sparkSession
    rows = [
        (rule, n, trigram, 1 << bit, (1 << len(needed)) - 1)
        for rule, options in queries.items()
        for n, needed in enumerate(options)
        for bit, trigram in enumerate(sorted(needed))
    ]
    wanted = F.broadcast(spark.createDataFrame(rows, "rule string, option int, trigram string, bit long, every long"))
    return (
        index.join(wanted, "trigram")
        .groupBy(*key, "rule", "option")
        .agg(F.bit_or("bit").alias("bits"), F.first("every").alias("every"))
        .where(F.col("bits") == F.col("every"))
        .groupBy(*key)
        .agg(F.collect_set("rule").alias("rules"))
    )


def spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) in code points of the rule's leftmost, non-overlapping matches that are long enough.

    What lies between the matches has known lengths, so running sums over gaps and matches give the positions.
    """
    pattern = _at_least(rule)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)) if rule.group else matches
    # Zipped, so that each array is made once per text and not once per match.
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), inner.alias("inner"))
    pieces = F.transform(
        F.filter(zipped, lambda z: z["match"].isNotNull()),
        lambda z: F.struct(
            F.length(z["gap"]).alias("gap"), F.length(z["match"]).alias("size"), (F.length(z["inner"]) >= rule.least).alias("ok")
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def follow(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + piece["size"]
        more = F.concat(state["out"], F.array(F.struct(begin.alias("start"), end.alias("end"))))
        return F.struct(end.alias("at"), F.when(piece["ok"], more).otherwise(state["out"]).alias("out"))

    def join(state: Column, part: Column) -> Column:
        moved = F.transform(part["out"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end")))
        return F.struct((state["at"] + part["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

    def in_parts(pieces: Column) -> Column:
        # Growing an array copies it, so sums run over parts of a fixed length and then over the parts.
        firsts = F.sequence(F.lit(0), F.floor(F.size(pieces) / PART).cast("int"))
        parts = F.transform(firsts, lambda n: F.aggregate(F.slice(pieces, n * PART + 1, F.lit(PART)), start, follow))
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int>>>").alias("out"))
        return F.aggregate(parts, empty, join, lambda state: F.flatten(state["out"]))

    # An array of one element, so that the pieces are made once and not once per part.
    return F.flatten(F.transform(F.array(pieces), in_parts))


def _tagged(found: Column, order: int, name: str) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(name).alias("kind")))


NO_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``found``) of every row: spans of all rules by start, then in the order of the rules.

    A null text is empty and holds nothing; rows of one key are judged by their own text, repeated rows
    alike; an empty table gives no rows. Other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = rows.withColumn("mark", F.xxhash64("body"))
    # The pair (key, mark) names a row up to repeats, which have the same spans.
    queries = {r.name: trigram_query(r.pattern) for r in rules}
    indexed = {name: q for name, q in queries.items() if q}
    by_scan = [r for r in rules if r.name not in indexed]

    def hits(rule: Rule) -> Column:
        return _tagged(spans(F.col("body"), rule), rules.index(rule), rule.name)

    empty = F.array().cast(NO_SPANS)
    parts = []
    for rule in by_scan:
        seen = rows.where(F.col("body").rlike(_at_least(rule)))
        parts.append(seen.select("key", "mark", hits(rule).alias("found")))
    if indexed:
        trigrams = sorted({t for q in indexed.values() for option in q for t in option})
        # Equal (key, mark) rows give equal postings, which the intersection counts once.
        index = store(postings(rows, ["key", "mark"], "body", trigrams), "trigrams")
        chosen = candidates(index, ["key", "mark"], indexed).withColumnsRenamed({"key": "_key", "mark": "_mark"})
        held = rows.join(chosen, F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark")))
        each = [F.when(F.array_contains("rules", r.name), hits(r)).otherwise(empty) for r in rules if r.name in indexed]
        parts.append(held.select("key", "mark", F.concat(*each).alias("found")))
    found = reduce(DataFrame.unionByName, parts).where(F.size("found") > 0).dropDuplicates(["key", "mark", "found"])
    found = store(found, "secrets").groupBy("key", "mark").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    found = found.withColumnsRenamed({"key": "_key", "mark": "_mark"})
    return rows.select("key", "mark").join(found, F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark")), "left").select(
        F.col("key").alias(key), F.coalesce("found", empty).alias("found")
    )


def _at_least(rule: Rule) -> str:
    """A pattern of the matches that may be long enough: a lone repeated class takes the length itself, with equal matches."""
    lone = rule.pattern.startswith("[") and rule.pattern.endswith("]+") and rule.pattern.count("[") == 1
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if rule.least and lone else rule.pattern


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
