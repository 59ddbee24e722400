"""Line dedup: lines that are instances of a template recurring across documents go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import let, once, salted, whole
from pairloom.session import stored

#: Distinct texts from which a template recurs; tokens from which a line has a template; distinct texts from which a shorter
#: line recurs as it stands (one or two words come together by chance); leading tokens that the tree looks at; share of a
#: template's tokens that must be fixed.
MIN_DOCS, MIN_TOKENS, SHORT_DOCS, DEPTH, FIXED = 2, 3, 10, 3, 0.7
_LAST = (1 << 63) - 1


def _mask(line: Column) -> Column:
    """The line with each token that holds a digit as a variable field."""
    line = F.trim(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<!\S)[^\s0-9]*+[0-9]\S*", "<*>")).otherwise(line)


def _lines(docs: DataFrame, *columns: str) -> DataFrame:
    """columns, pos, masked, tokens of each line that isn't blank; the text itself is left behind."""
    each = docs.select(*columns, F.split("text", "\n").alias("x")).select(*columns, F.posexplode("x").alias("pos", "x"))
    each = each.select(*columns, "pos", "x", once("masked", _mask(F.col("x")))).where("masked <> ''")
    return each.select(*columns, "pos", "x", "masked", once("tokens", F.split("masked", r"\s+")))


def _index(docs: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """doc, digest (of the text), pos (of the line), line, n (tokens), leaf (null: none) for each line that can recur:
    hashes only, stored, as all that follows starts from them. A line of figures is all variable fields and would be a
    template of any other: it stands for itself, with its figures."""
    rows = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), whole().alias("text"))
    rows = _lines(rows.select("doc", F.xxhash64("text").alias("digest"), "text"), "doc", "digest")
    words = F.size(F.filter("tokens", lambda t: t != "<*>"))
    rows = rows.select("doc", "digest", "pos", "x", "masked", "tokens", once("prose", words * 2 >= F.size("tokens")))
    line = F.when(F.col("prose"), F.xxhash64("masked")).otherwise(F.xxhash64(F.trim("x"), F.lit(0)))
    return stored(rows.select("doc", "digest", "pos", line.alias("line"), F.size("tokens").alias("n"), F.when(F.col("prose") & (F.size("tokens") >= min_tokens), F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth))).alias("leaf")))


def _templates(distinct: DataFrame, depth: int, fixed: float) -> DataFrame:
    """distinct lines (leaf, line, tokens) -> leaf, line, template (a hash of its fixed tokens by position) of those
    that have one.

    A position's support is how many distinct lines of the leaf have the same token there. The least support among the
    best-supported `fixed` of a line's positions is the size that its template can have; what has half of that at least
    (and is not in this line alone) is fixed, the rest are variable fields. Lines of equal fixed tokens are instances of
    one template, if they are at least half as many as that size: else its tokens are common ones that happen to meet.
    So a leaf holds any number of templates, and lines that have nothing to do with them don't count.
    """
    spots = distinct.select("leaf", "line", F.size("tokens").alias("n"), F.posexplode("tokens").alias("pos", "token"))
    later = spots.where(F.col("pos") >= depth).select("leaf", "line", "n", "pos", "token", F.xxhash64("leaf", "pos", "token").alias("spot"))
    support = later.groupBy("spot").agg(F.count(F.lit(1)).alias("c")).where("c >= 2")
    counted = later.join(support, "spot")  # a token that all lines of a large leaf share is left to AQE's splitting
    of_line = counted.groupBy("leaf", "line", "n").agg(F.sort_array(F.collect_list(F.struct("c", "pos", "token")), asc=False).alias("spots"))
    # the leading tokens, which all lines of a leaf share, are fixed; one more has to be at least
    rank = F.greatest(F.ceil(F.col("n") * fixed).cast("int") - depth, F.lit(1))
    size = F.get("spots", rank - 1)["c"]
    sure = F.filter("spots", lambda s: s["c"] * 2 >= F.col("size"))
    made = of_line.withColumn("size", size).where("size >= 2").select("leaf", "line", "n", "size", once("sure", sure))
    made = made.where((F.size("sure") + depth >= F.col("n") * fixed) & (F.size("sure") + depth < F.col("n")))
    shape = F.array_sort(F.transform("sure", lambda s: F.struct(s["pos"].alias("pos"), s["token"].alias("token"))))
    made = made.select("leaf", "line", "size", F.xxhash64("leaf", shape).alias("template"))
    enough = made.groupBy("template").agg(F.count(F.lit(1)).alias("lines"), F.min("size").alias("size")).where("lines >= 2 and lines * 2 >= size").select("template")
    return made.select("line", "template").join(enough, "template")


def recurring_templates(docs: DataFrame, index: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, fixed: float = FIXED, min_tokens: int = MIN_TOKENS, short_docs: int = SHORT_DOCS) -> DataFrame:
    """docs (doc_id, text) and their index -> line (hash of a masked line), first (the doc_id that keeps it).

    Template tree of fixed depth: the first level is the number of tokens, the next ones are the leading tokens, tokens
    with digits being variable. A leaf's templates are found from how many of its lines share a token by position (see
    _templates). A line belongs to its leaf's template or else to that of its own masked text. Templates of lines in at
    least min_docs different texts recur; a line of fewer than min_tokens tokens is a template of its own, and recurs from
    short_docs texts on. Copies of a whole text count as one text: they are near-dedup's work, and a
    document isn't boilerplate for having been copied.

    Counts are over hashes and combined before they shuffle. Tokens are fetched for leaves only in which different
    lines meet in min_docs texts, each distinct line once, from the first document that has it.
    """
    enough = F.when(F.col("n") < min_tokens, short_docs).otherwise(min_docs)
    own = index.groupBy("line", "n").agg(F.countDistinct("digest").alias("texts"), F.min("doc").alias("first")).where(F.col("texts") >= enough).select("line", "first")

    deep = index.where((F.col("n") > depth) & F.col("leaf").isNotNull())
    per_line = deep.groupBy("leaf", "line").agg(F.min(F.struct("doc", "digest", "pos")).alias("at"))
    wide = per_line.groupBy("leaf").agg(F.count(F.lit(1)).alias("n_lines")).where("n_lines > 1")
    texts = deep.groupBy("leaf").agg(F.countDistinct("digest").alias("texts")).where(F.col("texts") >= min_docs)
    wide = stored(wide.join(texts, "leaf").select("leaf"))
    fetch = per_line.join(wide, "leaf").groupBy(F.col("at.doc").alias("of"), F.col("at.digest").alias("of_digest")).agg(F.sort_array(F.collect_list(F.struct("at.pos", "line", "leaf"))).alias("wanted"))
    whole_docs = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), whole().alias("text")).withColumn("digest", F.xxhash64("text"))
    found = whole_docs.join(fetch, (F.col("doc") == F.col("of")) & (F.col("digest") == F.col("of_digest")))
    found = found.select("wanted", F.split("text", "\n").alias("x")).select(F.explode(F.transform("wanted", lambda w: F.struct(w["leaf"].alias("leaf"), w["line"].alias("line"), F.get("x", w["pos"]).alias("x")))).alias("w"))
    tokens = F.transform(F.split(_mask(F.col("w.x")), r"\s+"), lambda t: F.xxhash64(t))
    distinct = stored(found.select("w.leaf", "w.line", tokens.alias("tokens")).dropDuplicates(["leaf", "line"]))
    fitting = stored(_templates(distinct, depth, fixed))
    members = salted(index.select("line", "doc", "digest"), fitting, "line", F.col("doc"))
    groups = members.groupBy("template").agg(F.countDistinct("digest").alias("texts"), F.min("doc").alias("first")).where(F.col("texts") >= min_docs)
    general = fitting.join(groups, "template").select("line", "first")
    return own.union(general).groupBy("line").agg(F.min("first").alias("first"))


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH, fixed: float = FIXED, short_docs: int = SHORT_DOCS) -> DataFrame:
    """docs -> the same columns, text without recurring lines, with n_lines and n_dropped (long).

    Every line of a recurring template goes, save in the first document (least doc_id) that has one, so that no passage
    is lost from the corpus. See recurring_templates for the settings. Empty lines stay. Of lines more than half of whose tokens hold digits
    only those go that recur with the same figures. A null text stays null with 0 lines; an empty text has one empty
    line. Rows that share a doc_id are the same document; rows without doc_id come after all others. A text of any
    number of lines takes memory and time in proportion. Other columns pass through, save that n_lines and n_dropped are
    replaced.
    """
    index = _index(docs, min_tokens, depth)
    templates = recurring_templates(docs, index, min_docs, depth, fixed, min_tokens, short_docs)
    rows = index.select(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"), "pos", "line")
    gone = salted(rows, templates, "line", F.hash("_doc", "pos")).where("_doc > first")
    gone = gone.groupBy("_doc", "_digest").agg(F.sort_array(F.collect_set("pos")).alias("_gone"))
    at = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit(_LAST)).alias("_at"), F.xxhash64(whole()).alias("_of"))
    joined = at.join(gone, (F.col("_at") == F.col("_doc")) & (F.col("_of") == F.col("_digest")), "left")
    text, every = F.col("row")["text"], F.split(F.col("row")["text"], "\n")

    def rest(lines: Column) -> Column:
        """What lies between the lines that go, stretch by stretch."""
        after = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda p: p + 1))
        upto = F.concat(F.col("_gone"), F.array(F.size(lines)))
        return F.flatten(F.zip_with(after, upto, lambda a, b: F.slice(lines, a + 1, b - a)))

    kept = F.when(F.col("_gone").isNull(), text).otherwise(let(every, lambda lines: F.array_join(rest(lines), "\n")))
    lost = F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone"))
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(every))
    columns = [kept.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*columns, n_lines.cast("long").alias("n_lines"), lost.cast("long").alias("n_dropped"))
