"""Secret scans: a trigram inverted index proposes documents for each rule, the rule's regex verifies them.

DataFrame operations only. The regexes are parsed on the driver, without any row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, content_id, stored, table, text_or_empty


@dataclass(frozen=True)
class Rule:
    """One kind of secret. `pattern` reads alike in Java and Python; a match counts if `group` has `least` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: The kinds of the contract, in its order.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: Kinds that this scan adds.
MORE = (Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"))
RULES = BASE + MORE
#: Alternatives of one regex that are told apart; a part with more is left out of the query, which then admits more.
ALTERNATIVES = 64
#: Characters of a class that are told apart.
FEW_CHARACTERS = 8
#: Matches whose places are summed together.
CHUNK = 128
_GAP = None  # ends a run of literal characters
_TOKEN = re.compile(r"""\(\?[a-z]+\)|\[\^?\]?(?:\\.|[^\]\\])*\]|\\x[0-9A-Fa-f]{2}|\\.|\(\?:|[()|]|\{\d+(?:,\d*)?\}\??|[*+?]\??|.""", re.S)


class _Regex:
    """The literal runs of a regex of literals, classes, groups, alternatives and repeats; anything else is a gap.

    A run is a list of characters and gaps, and an alternative holds one; every match holds all runs of one alternative.
    """

    def __init__(self, pattern: str):
        self.tokens, self.at = _TOKEN.findall(pattern), 0

    def alternatives(self) -> list[list]:
        out, now = [], [[]]
        while self.at < len(self.tokens) and self.tokens[self.at] != ")":
            if self.tokens[self.at] == "|":
                self.at += 1
                out, now = out + now, [[]]
            else:
                more = self.repeated(self.one())
                now = [a + b for a in now for b in (more if len(now) * len(more) <= ALTERNATIVES else [[_GAP]])]
        return out + now

    def one(self) -> list[list]:
        token = self.tokens[self.at]
        self.at += 1
        if token in ("(", "(?:"):
            found = self.alternatives()
            self.at += 1  # the closing bracket
            return found
        if token.startswith("(?"):
            return [[]]  # flags
        if token[0] == "[" and len(token) > 1:
            inner = re.findall(r"\\x[0-9A-Fa-f]{2}|\\.|.", token[1:-1], re.S)
            plain = inner[0] != "^" and "-" not in inner[1:-1] and all(_character(c) for c in inner)
            return [[_character(c)] for c in inner] if plain and len(inner) <= FEW_CHARACTERS else [[_GAP]]
        return [[_character(token) if token not in (".", "^", "$") else _GAP]]

    def repeated(self, found: list[list]) -> list[list]:
        token = self.tokens[self.at] if self.at < len(self.tokens) else ""
        if not re.fullmatch(r"\{\d+(,\d*)?\}\??|[*+?]\??", token):
            return found
        self.at += 1
        least = int(re.match(r"\{(\d+)", token)[1]) if token[0] == "{" else int(token[0] == "+")
        if token[0] == "?":
            return [[], *found]
        return [[_GAP, *x, _GAP] for x in found] if least else [[_GAP]]


def _character(token: str) -> str | None:
    """The one character that a token stands for, or None."""
    if token.startswith("\\x") and len(token) == 4:
        return chr(int(token[2:], 16))
    if token.startswith("\\"):
        return token[1] if not token[1].isalnum() else None
    return token if len(token) == 1 else None


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The regex as an OR of ANDs of lower-cased trigrams: a text that matches holds all trigrams of one clause.

    Empty if some alternative has no trigram: such a rule scans all texts.
    """
    clauses = set()
    for runs in _Regex(pattern).alternatives():
        text = "".join("\0" if c is _GAP or not c.isascii() else c.lower() for c in runs)
        clauses.add(frozenset(x for k in range(len(text) - 2) if "\0" not in (x := text[k : k + 3])))
    if frozenset() in clauses:
        return []
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The inverted index (trigram, id) of the distinct texts, for the trigrams that some rule asks for."""
    folded = ascii_lower(text_or_empty())
    rows = docs.select(content_id(text_or_empty()).alias("id"), folded.alias("folded"))
    present = F.array_compact(F.array(*(F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in vocabulary)))
    return rows.select("id", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(id, kinds): the texts in the intersections of the postings that each kind's query asks for.

    Each posting meets the clauses that ask for its trigram (at most ALTERNATIVES for each rule), and a clause holds for
    the texts that have all of its trigrams. What is alike is folded before it is shuffled.
    """
    asks: dict[str, list[tuple[str, int, int, int]]] = {}
    for kind, clauses in queries.items():
        for n, clause in enumerate(clauses):
            for bit, trigram in enumerate(sorted(clause)):
                asks.setdefault(trigram, []).append((kind, n, bit, (1 << len(clause)) - 1))
    ask = lambda kind, n, bit, all_: F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("clause"), F.lit(1 << bit).cast("long").alias("bit"), F.lit(all_).cast("long").alias("all"))
    met = F.create_map(*(x for t, rows in sorted(asks.items()) for x in (F.lit(t), F.array(*(ask(*r) for r in rows)))))
    rows = index.select("id", F.explode(F.element_at(met, F.col("trigram"))).alias("a")).select("id", "a.*")
    held = rows.groupBy("id", "kind", "clause", "all").agg(F.bit_or("bit").alias("has")).filter(F.col("has") == F.col("all"))
    return held.groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def match_spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches, leftmost and not overlapping, as structs of start, rank, end in code points.

    The text is split at the matches, and the lengths of gaps and matches are summed: within chunks of CHUNK matches,
    and the chunks' totals then, so that a text of many matches costs little more for each of them.
    """
    matches, gaps = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    enough = lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m) >= rule.least
    item = lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("match"), enough(m).alias("counts"))
    items = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, item)
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")

    def grow(acc: Column, i: Column) -> Column:
        start = acc["at"] + i["gap"]
        end = start + i["match"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(i["counts"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    def chunked(all_: Column) -> Column:
        """The chunks as structs of their length `at` and their spans from their own start."""
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")), lambda n: F.aggregate(F.slice(all_, n * CHUNK + 1, F.lit(CHUNK)), start, grow))

    starts = lambda chunks: F.aggregate(chunks, F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c["at"])))
    moved = lambda c, by: F.transform(c["spans"], lambda s: F.struct((s["start"] + by).alias("start"), s["rank"].alias("rank"), (s["end"] + by).alias("end")))
    # Each step is bound to a name of its own by a list of one, so that it is worked out once.
    bound = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    whole = bound(items, lambda all_: bound(chunked(all_), lambda chunks: bound(starts(chunks), lambda at: F.flatten(F.zip_with(chunks, F.slice(at, F.lit(1), F.size(chunks)), moved)))))
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), whole).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of `docs` with `spans`, an array of (start, rank, end) by start and then by rule.

    Rules whose regex has mandatory trigrams read only texts that the index proposes; the others read all. A null text
    has no spans. Repeated rows and null ids are scanned like others. Column names that start with __tp_ are reserved.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    vocabulary = sorted({t for q in queries.values() for c in q for t in c})
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    rows = docs.withColumn("__tp_text", text_or_empty())
    if vocabulary:
        found = stored(candidates(postings(docs, vocabulary), queries), "secret-candidates").withColumnsRenamed({"id": "__tp_id", "kinds": "__tp_kinds"})
        rows = rows.withColumn("__tp_id", content_id(F.col("__tp_text"))).join(found, "__tp_id", "left")
    else:
        rows = rows.withColumns({"__tp_id": F.lit(None), "__tp_kinds": F.lit(None).cast("array<string>")})
    spans = []
    for rank, rule in enumerate(rules):
        found = match_spans(F.col("__tp_text"), rule, rank)
        spans.append(F.when(F.array_contains("__tp_kinds", rule.kind), found).otherwise(none) if queries[rule.kind] else found)
    return rows.withColumn("spans", F.array_sort(F.concat(*spans))).drop("__tp_id", "__tp_kinds", "__tp_text")


def span_list(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return out.select("doc_id", *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)), F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def _oracle() -> str:
    quoted = lambda r: "'" + r.pattern.replace("'", "''") + "'"
    lengths = lambda x: f"coalesce(list_sum(list_transform({x}, lambda y: length(y))), 0)"
    ctes, lists = [], []
    for k, r in enumerate(RULES):
        ctes.append(f"m{k} AS (SELECT rid, regexp_extract_all(t, {quoted(r)}) AS m, string_split_regex(t, {quoted(r)}) AS g FROM d)")
        got = f"length(regexp_extract(m[i], {quoted(r)}, {r.group}))" if r.group else "length(m[i])"
        start = f"({lengths('g[1:i]')} + {lengths('m[1:i-1]')})"
        ctes.append(f"s{k} AS (SELECT rid, {k} AS rank, '{r.kind}' AS kind, {start}::BIGINT AS a, ({start} + length(m[i]))::BIGINT AS b FROM (SELECT rid, m, g, unnest(range(1, len(m) + 1)) AS i FROM m{k}) WHERE {got} >= {r.least})")
        lists.append(f"SELECT * FROM s{k}")
    count = lambda k: f"count(*) FILTER (WHERE rank = {k})::BIGINT"
    item = "kind || ':' || a || ':' || b"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(ctes)}, s AS ({" UNION ALL ".join(lists)})
SELECT any_value(d.doc_id) AS doc_id, {", ".join(f"{count(k)} AS n_{r.kind}" for k, r in enumerate(BASE))},
  sha256(coalesce(string_agg({item}, ',' ORDER BY a, rank) FILTER (WHERE rank < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg({item}, ',' ORDER BY a, rank) FILTER (WHERE rank IS NOT NULL), '') AS spans
FROM d LEFT JOIN s USING (rid) GROUP BY rid"""


ORACLE = _oracle()
