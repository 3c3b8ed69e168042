"""Secrets in texts: strong patterns, and weak parts of credentials linked by an interval join.

Strong parts are reported wherever they match. Weak parts (account names, bare random strings,
endpoints) are candidates only: they are reported where the parts that complete a credential lie
within ``reach`` characters in the same scope, which is one text.

Only DataFrame functions are used. ``split`` by a pattern gives the gaps between its matches and
``regexp_extract_all`` the matches, so running sums of both lengths give every position in
linear time. The interval join is a window over ranges of positions: it counts the parts of each
role within reach and never forms pairs. Texts without any part never leave their task, and
equal texts are worked on once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

#: Kinds in their order, with pattern, least length of group 2 or of the match, and role.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
USER = r"""(?i:(username|user|login|account|client_?id|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,64}(?![A-Za-z0-9+/])"
ENDPOINT = r"""(?:https?|ftp|ssh|s3|amqps?|redis|mysql|postgres(?:ql)?|mongodb(?:\+srv)?)://[^\x09-\x0D\x20"'<>]+"""

KINDS = ("assign", "access", "hex", "user", "key", "endpoint")
PATTERNS = (ASSIGN, ACCESS, HEX, USER, KEY, ENDPOINT)
STRONG = 3
IDENTIFIERS = ("access", "user")
SECRETS = ("assign", "hex", "key")
#: Characters between the beginnings of parts that belong together, at most.
REACH = 300
MASK = "[SECRET]"

_ANY_STRONG = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _has_parts(body: Column) -> Column:
    """Whether a text can have a span: a strong part, or a weak identifier and a weak secret."""
    return body.rlike(_ANY_STRONG) | (body.rlike(KEY) & body.rlike(USER))


def _matches(body: Column, kind: int) -> Column:
    """Matches of a kind in order: kind, number, characters before it since the last, its own, whether it counts."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(body, F.lit(pattern), F.lit(2)) if KINDS[kind] in ("assign", "user") else found
    zipped = F.arrays_zip(F.split(body, pattern, -1).alias("gap"), found.alias("match"), value.alias("value"))

    def row(x: Column, n: Column) -> Column:
        v = x["value"]
        counts = {"assign": F.length(v) >= 6, "key": v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")}
        return F.struct(F.lit(kind).alias("kind"), n.alias("nth"), F.length(x["gap"]).alias("gap"),
                        F.length(x["match"]).alias("size"), counts.get(KINDS[kind], F.lit(True)).alias("ok"))

    return F.slice(F.transform(zipped, row), F.lit(1), F.size(found))


def spans(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """(key, spans) for every text that has any: key is its digest, spans is sorted by start and kind.

    A span has start, kind (its place in KINDS), stop and covered: how far earlier spans reach.
    Positions count code points, stops are exclusive. A weak part that overlaps a strong one
    belongs to that one and is no part of its own.
    """
    body = _text(text)
    hit = docs.select(body.alias("body")).where(_has_parts(F.col("body")))
    parts = F.concat(*(_matches(F.col("body"), k) for k in range(len(KINDS))))
    once = hit.select(F.md5("body").alias("key"), parts.alias("parts")).groupBy("key").agg(F.first("parts").alias("parts"))
    rows = once.select("key", F.inline("parts"))
    so_far = Window.partitionBy("key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("stop", F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far)).where("ok") \
        .select("key", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop", (F.col("kind") < STRONG).alias("strong"))

    order = Window.partitionBy("key").orderBy("start", "kind")
    before = F.max(F.when(F.col("strong"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(F.col("strong"), F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("before", before).withColumn("after", after) \
        .where("strong OR (coalesce(before, 0) <= start AND coalesce(after, stop) >= stop)")

    near = Window.partitionBy("key").orderBy("start").rangeBetween(-reach, reach)
    count = lambda names: F.sum(F.col("kind").isin([KINDS.index(n) for n in names]).cast("int")).over(near)
    rows = rows.withColumn("identifiers", count(IDENTIFIERS)).withColumn("secrets", count(SECRETS))
    linked = F.when(F.col("strong"), F.lit(True)) \
        .when(F.col("kind") == KINDS.index("user"), F.col("secrets") > 0) \
        .when(F.col("kind") == KINDS.index("key"), F.col("identifiers") > 0) \
        .otherwise((F.col("identifiers") > 0) & (F.col("secrets") > 0))
    covered = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.where(linked).withColumn("covered", covered).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "covered"))).alias("spans"))


def _listed(found: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked), one row per row of ``docs``.

    spans lists kind:start:stop by start, then kind; base_sha256 is the digest of the list of the
    strong ones; n_linked counts the weak ones. Null and empty texts have none. Rows that repeat
    get the same answer, ids may be null, other columns are ignored.
    """
    found = spans(docs, text, reach)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.md5(_text(text)).alias("key")).join(found, "key", "left")
    every = F.coalesce("spans", F.expr("cast(array() as array<struct<start: bigint, kind: int, stop: bigint, covered: bigint>>)"))
    rows = rows.withColumn("every", every)
    strong = F.filter("every", lambda s: s["kind"] < STRONG)
    number = lambda kind: F.size(F.filter("every", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_listed(strong).cast("binary"), 256).alias("base_sha256"), _listed(F.col("every")).alias("spans"),
        F.size(F.filter("every", lambda s: s["kind"] >= STRONG)).cast("long").alias("n_linked"))


def redact(docs: DataFrame, text: str = "text", reach: int = REACH, mask: str = MASK) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask``; spans that overlap are replaced as one.

    Only rows whose text can have spans take part in the join; all others pass through. Nulls
    stay null, and columns and rows stay as they are.
    """
    body = _text(text)
    found = spans(docs, text, reach).withColumnRenamed("spans", "__spans").withColumnRenamed("key", "__key")
    may = _has_parts(body)
    hit = docs.where(may).withColumn("__key", F.md5(body)).join(found, "__key", "left")
    cut = lambda s: F.when(s["start"] >= s["covered"], F.concat(
        F.substring(body, (s["covered"] + 1).cast("int"), (s["start"] - s["covered"]).cast("int")), F.lit(mask))).otherwise("")
    end = F.array_max(F.transform("__spans", lambda s: s["stop"])).cast("int")
    clean = F.concat(F.array_join(F.transform("__spans", cut), ""), F.substring(body, end + 1, F.length(body)))
    names = docs.columns
    hit = hit.withColumn(text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(clean)).select(names)
    return docs.where(~may).select(names).unionByName(hit)
