"""Secret scans in built-in functions: strong patterns alone, weak ones when complementary parts lie close together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.staging import staged

REACH = 200


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""
_KEYWORDS = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
_NAMES = "|".join(map(_any_case, ("access_?key_?id", "client_?id", "username", "user", "login", "account")))
_HOSTS = "|".join(map(_any_case, ("host", "endpoint", "server")))
_SCHEMES = "https?|wss?|ftp|jdbc|postgres|postgresql|mysql|mongodb|redis|amqp|s3"

PATTERNS = {
    "assign": rf"({_KEYWORDS}){_ASSIGNED}([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "id": rf"A(?:KIA|SIA|IDA|ROA)[A-Z0-9]{{8,}}|(?:{_NAMES}){_ASSIGNED}[A-Za-z0-9@+/_.-]{{3,}}",
    "key": r"[A-Za-z0-9+/_=-]{16,}",
    "endpoint": rf"""(?:{_SCHEMES})://[^\x20\x09-\x0D"'<>]+|(?:{_HOSTS}){_ASSIGNED}[A-Za-z0-9._-]{{3,}}""",
}
"""Patterns that Java and RE2 read alike, in the order of kinds.  ``{16,}`` and ``{24,}`` equal ``+`` with a check of the
length afterwards, as these matches are whole runs; ``assign`` consumes failing matches and is checked afterwards."""
KINDS = list(PATTERNS)
STRONG = KINDS[:3]
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "id"), ("assign", "hex", "key"), ("endpoint",)
_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _spans(text: Column, kind: str) -> Column:
    """Spans of a kind's leftmost matches that do not overlap, in code points.

    The pieces between the matches and the matches alternate, so their lengths add up to the positions.
    """
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind == "assign":
        value = F.regexp_extract_all(text, pattern, F.lit(2))
        found = F.zip_with(found, value, lambda f, v: F.struct(F.length(f).alias("n"), (F.length(v) >= 6).alias("ok")))
    else:
        ok = {
            "id": lambda f: ~((F.length(f) >= 20) & f.rlike("^AKIA[A-Z0-9]+$")),
            "key": lambda f: f.rlike("[0-9]") & f.rlike("[A-Za-z]") & ~f.rlike("^[0-9a-f]{24,}$|^AKIA[A-Z0-9]{16,}$"),
        }.get(kind, lambda f: F.lit(True))
        found = F.transform(found, lambda f: F.struct(F.length(f).alias("n"), ok(f).alias("ok")))
    steps = F.zip_with(
        F.split(text, PATTERNS[kind], -1),
        found,
        lambda piece, match: F.struct(F.length(piece).alias("gap"), match["n"].alias("n"), match["ok"].alias("ok")),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(done, one):
        begin = done["at"] + one["gap"]
        end = begin + F.coalesce(one["n"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(one["ok"], F.concat(done["out"], F.array(span))).otherwise(done["out"]).alias("out"))

    return F.when(text.rlike(PATTERNS[kind]), F.aggregate(steps, start, step, lambda done: done["out"])).otherwise(F.array().cast(_SPAN))


def _rendered(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def _is(kind: Column, kinds: tuple[str, ...]) -> Column:
    return kind.isin([KINDS.index(k) for k in kinds])


def _scanned(docs: DataFrame, reach: int, text_col: str, keep_text: bool) -> DataFrame:
    """``c0, c1, …, row, base, spans``: the columns of ``docs`` by place (without its text unless ``keep_text``), so that
    none can clash with a name used here, and the spans as in ``scan_secrets``."""
    at = docs.columns.index(text_col)
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    kept = [c for i, c in enumerate(rows.columns) if keep_text or i != at]
    text = F.coalesce(F.col(f"c{at}").cast("string"), F.lit(""))
    found = rows.select(
        *kept,
        F.monotonically_increasing_id().alias("row"),
        F.array_sort(F.concat(*(_spans(text, k) for k in STRONG))).alias("base"),
        F.concat(*(_spans(text, k) for k in KINDS[3:])).alias("weak"),
    )
    found = staged(found, "spans")
    may_link = "size(weak) > 0 AND size(weak) + size(base) > 1"
    paired = found.where(may_link)
    parts = paired.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*")
    low, high = F.floor(F.col("start") / reach), F.floor(F.col("end") / reach)
    weak = parts.where(F.col("kind") >= len(STRONG)).withColumn("bin", F.explode(F.sequence(low - 1, high + 1)))
    other = parts.where(~_is(F.col("kind"), ENDPOINTS)).select(
        "row", F.explode(F.sequence(low, high)).alias("bin"), F.col("start").alias("at"), F.col("end").alias("to"), F.col("kind").alias("other")
    )
    gap = F.greatest("start", "at") - F.least("end", "to")
    beside = weak.join(other, ["row", "bin"]).where(gap <= reach)
    complements = beside.groupBy("row", "start", "kind", "end").agg(
        F.max(_is(F.col("other"), IDENTIFIERS)).alias("identifier"), F.max(_is(F.col("other"), SECRETS)).alias("secret")
    )
    linked = complements.where(
        F.when(_is(F.col("kind"), IDENTIFIERS), F.col("secret"))
        .when(_is(F.col("kind"), SECRETS), F.col("identifier"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    linked = linked.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    spans = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN))))
    # Rows that cannot have links go past the join, so their texts are not shuffled.
    joined = paired.join(linked, "row", "left").select(*kept, "row", "base", spans.alias("spans"))
    alone = found.where(f"NOT ({may_link})").select(*kept, "row", "base", F.col("base").alias("spans"))
    return joined.union(alone)


def scan_secrets(docs: DataFrame, reach: int = REACH, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``base`` and ``spans``: arrays of ``(start, kind, end)`` sorted by start and kind.

    ``base`` has the strong kinds (``assign``, ``access``, ``hex``).  ``spans`` adds weak parts that complement each other:
    an identifier (``id``) beside a secret, a secret (``key``) beside an identifier, an ``endpoint`` beside both, where
    strong spans count as parts, too.  Beside means that ``reach`` code points at most lie between the parts.

    One pass over the texts finds all spans; they are written with a row number.  Parts then meet in an interval join:
    each lies in the bins from its start to its end, weak parts look one bin further on both sides in their own row.
    Matches do not overlap, so a bin holds few and no key is hot, however many rows share a text.

    Defined cases: null text is empty; repeated rows are kept apart; other columns are kept as they are, but columns
    named ``base`` or ``spans`` are replaced; no rows give no rows.
    """
    found = _scanned(docs, reach, text_col, keep_text=False)
    named = [(f"c{i}", c) for i, c in enumerate(docs.columns) if c not in (text_col, "base", "spans")]
    return found.select(*(F.col(place).alias(c) for place, c in named), "base", "spans")


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Counts of the strong kinds, a digest of the strong spans, and all spans as text, one row a document."""
    found = scan_secrets(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), reach)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, STRONG), F.sha2(_rendered(F.col("base")), 256).alias("base_sha256"), _rendered(F.col("spans")).alias("spans")
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", reach: int = REACH) -> DataFrame:
    """All documents with the same columns; every secret in a text is replaced by ``[secret]``.

    Overlapping spans become one mark.  ``length_col`` is set to the new length where a text changed.

    Defined cases: null text stays null; repeated rows are kept; all other columns keep their values whatever their
    names; no rows give no rows.
    """
    names = docs.columns
    found = _scanned(docs, reach, text_col, keep_text=True)
    place = f"c{names.index(text_col)}"
    text = F.coalesce(F.col(place).cast("string"), F.lit(""))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done, span):
        gap = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        out = F.when(span["start"] >= done["at"], F.concat(done["out"], gap, F.lit("[secret]"))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    def finish(done):
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))

    hit = F.size("spans") > 0
    found = found.withColumn("clean", F.when(hit, F.aggregate("spans", start, step, finish)).otherwise(F.col(place)))
    changed = {place: F.col("clean")}
    if length_col in names and length_col != text_col:
        at = f"c{names.index(length_col)}"
        changed[at] = F.when(hit, F.length("clean").cast(docs.schema[length_col].dataType)).otherwise(F.col(at))
    return found.select(*(changed.get(f"c{i}", F.col(f"c{i}")).alias(c) for i, c in enumerate(names)))
