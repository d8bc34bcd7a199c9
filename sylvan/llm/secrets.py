"""Secret scan with multipart credential linking, DataFrame functions only.

Base findings (assignments, access keys, long hex) stand on their own.
Weak candidates (account identifiers, bare 40-character keys, endpoints)
are reported only when a complementary part lies in the same scope: parts
are dealt to position bins of one document and interval-joined with the
parts of the neighbouring bins.

Spans are in code points, end exclusive. Matches are leftmost and do not
overlap within a kind; those that are too short are dropped afterwards.

Defined cases: a null text is empty; rows that share a ``doc_id`` are
scanned each on its own (rows get an id in a written table); spans of
different kinds may overlap; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.llm.common import written

# The patterns, in the order in which kinds are listed. (kind, pattern, group that
# is measured, its least length). Hex and access runs are greedy, so the least length can stand in
# the pattern: a shorter run holds no longer one.
BASE = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
#: Weak parts, and what each needs nearby: an identifier or endpoint needs a secret, a bare key an identifier or endpoint.
WEAK = [
    ("ident", r"""(?:[Aa]ccess_?[Kk]ey_?[Ii][Dd]|[Cc]lient_?[Ii][Dd]|[Uu]ser(?:_?[Nn]ame)?|[Ll]ogin)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""", 1, 3),
    ("barekey", r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", 0, 40),
    ("endpoint", r"""https?://[^\s"'<>]+""", 0, 10),
]
KINDS = [k[0] for k in BASE + WEAK]
#: What a kind is as a part of a credential.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "ident": "id", "barekey": "secret", "endpoint": "place"}
NEEDS = {"ident": ["secret"], "barekey": ["id", "place"], "endpoint": ["secret"]}
#: A literal that every match holds, where there is a cheap one: it spares the pattern in most texts.
HINT = {"access": "AKIA", "endpoint": "://"}


def _found(text: Column, kind: str, pattern: str) -> Column:
    got = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.contains(HINT[kind]), got) if kind in HINT else got


def _measured(text: Column, found: Column, pattern: str, group: int) -> Column:
    """Lengths of the gaps, matches and measured groups: array of (gap, match, group)."""
    gaps = F.split(text, pattern, -1)
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if group else found
    made = F.transform(found, lambda m, i: F.struct(
        F.char_length(F.element_at(gaps, i + 1)).alias("gap"), F.char_length(m).alias("len"), F.char_length(F.element_at(groups, i + 1)).alias("part")))
    return F.when(F.size(found) > 0, made)


def find_parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document with a row id (``uid, doc_id``), and every base finding and weak part
    (``uid, kind, start, end``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    scan = docs.select("doc_id", text.alias("_text"))
    scan = scan.select("*", *[_found(F.col("_text"), k, p).alias(f"_{k}") for k, p, _, _ in BASE + WEAK])
    scan = scan.select(
        F.monotonically_increasing_id().alias("uid"),
        "doc_id",
        *[_measured(F.col("_text"), F.col(f"_{k}"), p, g).alias(k) for k, p, g, _ in BASE + WEAK],
    )
    scan = written(scan, "secret-scan")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(least).alias("least"), F.col(k).alias("found")) for k, _, _, least in BASE + WEAK])
    # running sums by a window over a document's matches of one kind: linear in their number
    w = Window.partitionBy("uid", "kind").orderBy("_i")
    some = F.greatest(*[F.coalesce(F.size(k), F.lit(0)) for k in KINDS]) > 0
    parts = (
        scan.filter(some)
        .select("uid", F.explode(kinds).alias("_k"))
        .select("uid", "_k.kind", "_k.least", F.posexplode("_k.found").alias("_i", "_m"))
        .withColumn("end", F.sum(F.col("_m.gap") + F.col("_m.len")).over(w))
        .filter(F.col("_m.part") >= F.col("least"))
        .select("uid", "kind", (F.col("end") - F.col("_m.len")).alias("start"), "end")
    )
    return scan.select("uid", "doc_id"), written(parts, "secret-parts")


def _map(pairs: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[key]


def link(parts: DataFrame, scope: int = 256) -> DataFrame:
    """The weak parts with a complementary part at most ``scope`` code points away (gap between the spans).

    Interval join: a part lies in each bin of ``scope`` code points that its
    span, widened by ``scope`` on either side, touches, borders included; a
    weak part asks in the bins from its start to its end. Where the gap is at
    most ``scope`` the two share a point, and so a bin. A (document, bin) pair
    holds the parts of a few bins at most, so no group grows with the input. A
    left-semi join emits no pairs.
    """
    role = _map(ROLE, F.col("kind"))
    weak = parts.filter(F.col("kind").isin(*NEEDS)).select(
        "*", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("_bin"))
    others = parts.select(
        F.col("uid").alias("_u"), role.alias("_role"), F.col("start").alias("_s"), F.col("end").alias("_e"),
        F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))).alias("_b"))
    fits = F.lit(False)
    for kind, roles in NEEDS.items():
        fits = fits | ((F.col("kind") == kind) & F.col("_role").isin(*roles))
    near = (F.col("_s") <= F.col("end") + scope) & (F.col("_e") + scope >= F.col("start"))
    # a part does not support itself, nor does another reading of the same characters
    apart = (F.col("_s") >= F.col("end")) | (F.col("_e") <= F.col("start"))
    return weak.join(others, (F.col("uid") == F.col("_u")) & (F.col("_bin") == F.col("_b")) & fits & near & apart, "left_semi").select("uid", "kind", "start", "end").distinct()


def scan_secrets(docs: DataFrame, scope: int = 256) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_spans, spans`` for each input row.

    Both span columns are arrays of (start, order, end, kind), sorted.
    """
    rows, parts = find_parts(docs)
    base = [k[0] for k in BASE]
    order = _map({k: str(i) for i, k in enumerate(KINDS)}, F.col("kind")).cast("int")
    spans = parts.filter(F.col("kind").isin(*base)).unionByName(link(parts, scope))
    # a group is one document's findings; documents are rows, so it is bounded by a row
    grouped = spans.select("uid", F.struct("start", order.alias("order"), "end", "kind").alias("s")).groupBy("uid").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    out = rows.join(grouped, "uid", "left").withColumn("spans", F.coalesce(F.col("spans"), none))
    out = out.withColumn("base_spans", F.filter("spans", lambda s: s["order"] < len(base)))
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in base], "base_spans", "spans")


def span_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
