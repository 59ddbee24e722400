"""Secret scans over an inverted index of trigrams."""

from __future__ import annotations

from dataclasses import dataclass
from re import _parser as regex_syntax

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import let, whole


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern`, leftmost and non-overlapping, whose `group` has at least `least` code
    points. Patterns keep to what Java, Python and RE2 read alike."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The kinds that are always looked for, in the order in which they are listed.
BASE = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Published token formats.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"[a-z][a-z0-9+.-]*://[^/ @:]+:[^/ @:]+@"),
)
RULES = BASE + MORE
#: Matches of one rule in one text whose places are worked out together.
BLOCK = 128

#: A query over trigrams of the lower-cased text: True (any text), a trigram, ("and", ...) or ("or", ...).
Query = bool | str | tuple


def _all(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: set[str]) -> Query:
    """What a text that holds one of the strings has."""
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _strings(node: tuple, most: int) -> set[str] | None:
    """All (lower-cased) strings that a part of a pattern can match, if they are few."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
        out = {chr(a).lower() for _, a in arg}
        return out if len(out) <= 6 else None
    if op == "SUBPATTERN":
        return _product(arg[3], most)
    if op == "BRANCH":
        sets = [_product(b, most) for b in arg[1]]
        return None if None in sets or len(out := set().union(*sets)) > most else out
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 1:
        inner = _product(arg[2], most)
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    if op == "AT":
        return {""}
    return None


def _product(parts: list, most: int) -> set[str] | None:
    out = {""}
    for p in parts:
        s = _strings(p, most)
        if s is None or len(out) * len(s) > most:
            return None
        out = {a + b for a in out for b in s}
    return out


def _of_part(node: tuple, most: int) -> Query:
    op, arg = str(node[0]), node[1]
    if op == "SUBPATTERN":
        return _of_sequence(arg[3], most)
    if op == "BRANCH":
        return _any([_of_sequence(b, most) for b in arg[1]])
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
        return _of_sequence(arg[2], most)
    return True


def _of_sequence(parts: list, most: int) -> Query:
    found, run = [], {""}
    for p in parts:
        s = _strings(p, most)
        if s is not None and len(run) * len(s) <= most:
            run = {a + b for a in run for b in s}
        else:
            found += [_of_strings(run), _of_part(p, most) if s is None else True]
            run = {""} if s is None else s
    return _all([*found, _of_strings(run)])


def trigram_query(pattern: str, most: int = 32) -> Query:
    """Boolean query that holds for every text with a match of the pattern; True if the pattern has no mandatory
    trigrams. Runs of characters that can only match up to `most` strings are taken together."""
    return _of_sequence(list(regex_syntax.parse(pattern)), most)


def _vocabulary(q: Query) -> set[str]:
    return {q} if isinstance(q, str) else set().union(*map(_vocabulary, q[1:])) if isinstance(q, tuple) else set()


def _holds(q: Query, of_doc: str) -> Column:
    if isinstance(q, str):
        return F.array_contains(of_doc, q)
    parts = [_holds(x, of_doc) for x in q[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if q[0] == "and" else out | p
    return out


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs (doc_id, text) -> doc_id, kinds: the rules whose trigram query the document's postings meet.

    The index holds, of the trigrams that some query names, a posting (trigram, doc_id) for each document that has it;
    postings are intersected by document. Rules without mandatory trigrams aren't listed: they scan every text.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not True}
    grams = sorted(set().union(*map(_vocabulary, queries.values())) if queries else ())
    held = let(F.lower(whole()), lambda t: F.filter(F.array(*map(F.lit, grams)).cast("array<string>"), lambda g: F.contains(t, g)))
    postings = docs.select("doc_id", F.explode(held).alias("trigram"))
    by_doc = postings.groupBy("doc_id").agg(F.collect_set("trigram").alias("grams"))
    kinds = F.array_compact(F.array(*[F.when(_holds(q, "grams"), F.lit(k)) for k, q in queries.items()])).cast("array<string>")
    return by_doc.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


_SPAN = "struct<start:int,order:int,kind:string,end:int,size:int>"


def _blocks(n: Column) -> Column:
    """0, BLOCK, 2 * BLOCK, ... below n."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, r: Rule, order: int) -> Column:
    """Spans of one rule in code points: what lies between matches gives their places.

    Matches are taken in blocks: first the length of each block, then where each one starts, then the spans within. An
    array is only ever appended to within a block or once a block, so very many matches don't cost their square."""

    def placed(between: Column, found: Column, sized: Column) -> Column:
        length = lambda i: F.length(between[i]) + F.length(found[i])
        inside = lambda b: F.sequence(b, F.least(b + BLOCK, F.size(found)) - 1)
        sums = F.transform(_blocks(F.size(found)), lambda b: F.struct(b.alias("b"), F.aggregate(inside(b), F.lit(0), lambda acc, i: acc + length(i)).alias("n")))
        begun = lambda acc, s: F.struct((acc["end"] + s["n"]).alias("end"), F.concat(acc["out"], F.array(F.struct(s["b"].alias("b"), acc["end"].alias("at")))).alias("out"))
        starts = F.aggregate(sums, F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<b:int,at:int>>").alias("out")), begun)["out"]
        start = lambda acc, i: acc["end"] + F.length(between[i])
        one = lambda acc, i: F.struct((acc["end"] + length(i)).alias("end"), F.concat(acc["out"], F.array(F.struct(start(acc, i).alias("start"), F.lit(order).alias("order"), F.lit(r.kind).alias("kind"), (acc["end"] + length(i)).alias("end"), F.length(sized[i]).alias("size")))).alias("out"))
        of_block = lambda s: F.aggregate(inside(s["b"]), F.struct(s["at"].alias("end"), F.array().cast(f"array<{_SPAN}>").alias("out")), one)["out"]
        return F.filter(F.flatten(F.transform(starts, of_block)), lambda s: s["size"] >= r.least)

    return let(F.split(text, r.pattern, -1), lambda b: let(F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0)), lambda m: let(F.regexp_extract_all(text, F.lit(r.pattern), F.lit(r.group)), lambda g: placed(b, m, g))))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs (doc_id, text) -> doc_id, spans array<struct<start, order, kind, end, size>>, sorted by start, then by the
    rules' order. One row for each row of docs.

    Start and end count code points, end is exclusive; size is that of the group that must be long enough. Rules with
    a trigram query run only on the documents that the index finds for them, the rest on every text: a document is read
    whole, however long. A null text is empty and has no spans. Rows that share a doc_id (or have none) share their
    candidate rules, which only means that a text is searched where it need not be. Other columns are ignored.
    """
    d = docs.select("doc_id", whole().alias("text"))
    c = candidates(d, rules).withColumnRenamed("doc_id", "at")
    j = d.join(c, d["doc_id"].eqNullSafe(c["at"]), "left")
    none = F.array().cast(f"array<{_SPAN}>")
    found = []
    for i, r in enumerate(rules):
        to_read = F.col("text").rlike(r.pattern) if trigram_query(r.pattern) is True else F.array_contains("kinds", r.kind)
        found.append(F.when(F.coalesce(to_read, F.lit(False)), _spans(F.col("text"), r, i)).otherwise(none))
    return j.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
