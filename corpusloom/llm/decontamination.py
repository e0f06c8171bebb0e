"""Benchmark decontamination by templates: numbers, names and units become placeholders before texts are compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.staging import staged
from corpusloom.llm.textbytes import row_of, sequence_hashes, slices, span_hashes, word_bounds
from corpusloom.plans.offsets import small_side

WINDOW = 5
SHARE = 0.8
RUN = 13
LITERALS = 3
STRETCH = 4
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams pound pounds ounce ounces ton tons ml l "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years percent dollar dollars euro euros cent cents mph kmh degree degrees watt watts volt volts"
).split()
FILTER_BITS = 24
_NUMBER, _NAME, _UNIT = (np.uint64(k) for k in (1, 2, 3))
_WORDY = np.zeros(256, bool)
_WORDY[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _bytes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(w) for w in words])
    return np.frombuffer("".join(words).encode(), np.uint8), ends - [len(w) for w in words], ends


def template(data: np.ndarray, at: np.ndarray, units: list[str] = UNITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(tokens, values, slot flags, first token of each row)`` of the texts of a slice.

    A token is the hash of a lower-cased word without marks around it (words of marks alone are left out), or a
    placeholder: a number (digits with marks between; digits and letters that begin with a digit), a unit (a word of
    ``units`` after a number) or a name (a capital before a small letter, at the start of a sentence as well: a question
    may open with the name that changes).  ``values`` are the words' own hashes.
    """
    starts, ends, firsts = word_bounds(data, at)
    none = np.zeros(0, np.uint64)
    if not len(starts):
        return none, none, np.zeros(0, bool), np.zeros(len(at), np.int64)
    upper = (data > 64) & (data < 91)
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[1:] != 0x97)
    low = data + np.uint8(32) * (upper | accented)
    wordy = _WORDY[data]
    place = np.arange(len(data))
    last = np.maximum.accumulate(np.where(wordy, place, -1))[ends - 1]
    first = np.minimum.accumulate(np.where(wordy, place, len(data))[::-1])[::-1][starts]
    keep = first <= last
    keep &= first < ends
    rows = row_of(firsts)[keep]
    first, last = first[keep], last[keep] + 1
    values = span_hashes(low, first, last)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    number = (digits[last] > digits[first]) & _DIGIT[data[first]]
    capital = upper[first] | ((data[first] == 0xC3) & accented[np.minimum(first + 1, len(data) - 1)])
    tokens = values.copy()
    small = np.concatenate([[0], np.cumsum(wordy & ~_DIGIT[data] & (low == data) & (data != 0xC3))])
    name = capital & (small[last] > small[first])
    unit = np.zeros(len(tokens), bool)
    unit[1:] = np.isin(values[1:], span_hashes(*_bytes_of(units))) & number[:-1] & (rows[1:] == rows[:-1])
    tokens[name], tokens[number], tokens[unit] = _NAME, _NUMBER, _UNIT
    return tokens, values, name | number | unit, np.searchsorted(rows, np.arange(len(at)))


def _windows(tokens, values, slots, firsts, window: int, literals: int, stretch: int):
    """``(hashes, starts, ends, in template form)`` of the windows of each row.

    In template form a window that has fewer than ``literals`` words outside slots goes on until it has them, up to
    ``stretch`` times its length.  A window with slots is also there word for word: a copy in capitals shows no names.
    """
    start = np.arange(len(tokens))
    limit = firsts[1:][row_of(firsts)]
    words = np.flatnonzero(~slots)
    nth = np.cumsum(~slots) - ~slots + min(literals, window) - 1
    end = np.append(words, len(tokens) + stretch * window)[np.minimum(nth, len(words))] + 1
    end = np.maximum(end, start + window)
    a = np.flatnonzero((end <= limit) & (end <= start + stretch * window))
    before = np.concatenate([[0], np.cumsum(slots)])
    b = np.flatnonzero(start + window <= limit)
    b = b[before[b + window] > before[b]]
    h = [sequence_hashes(tokens, a, end[a]), sequence_hashes(values, b, b + window)]
    return np.concatenate(h), np.concatenate([a, b]), np.concatenate([end[a], b + window]), np.arange(len(a) + len(b)) < len(a)


def template_windows(
    table: DataFrame,
    key_cols: list[str],
    text_col: str,
    window: int = WINDOW,
    literals: int = LITERALS,
    stretch: int = STRETCH,
    units: list[str] = UNITS,
    bits: np.ndarray | None = None,
) -> DataFrame:
    """``(*key_cols, h, pos, total, slots)`` of the windows of every text, or of those that ``bits`` may know.

    ``total`` is the number of windows in template form in the text (of all windows, where it has none); ``slots`` holds
    the hash of the word in each slot.
    """

    def run(batches):
        for batch in batches:
            for row, end, data, at in slices(batch.column(len(key_cols)), 1 << 20):
                tokens, values, slots, firsts = template(data, at, units)
                h, starts, ends, form = _windows(tokens, values, slots, firsts, window, literals, stretch)
                rows = row_of(firsts)[starts]
                totals = np.bincount(rows[form], minlength=end - row)
                totals = np.where(totals > 0, totals, np.bincount(rows, minlength=end - row))
                if bits is not None:
                    place = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    known = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1
                    h, starts, ends, rows, form = (x[known > 0] for x in (h, starts, ends, rows, form))
                if not len(h):
                    continue
                before = np.concatenate([[0], np.cumsum(slots)])
                held = values[slots].view(np.int64)
                a = before[starts]
                b = np.where(form, before[ends], a)
                cuts = np.concatenate([[0], np.cumsum(b - a)])
                take = np.repeat(a - cuts[:-1], b - a) + np.arange(int(cuts[-1]))
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(held[take]))
                which = pa.array(rows + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).take(which) for i in range(len(key_cols))),
                        pa.array(h.view(np.int64)),
                        pa.array(starts - firsts[rows]),
                        pa.array(totals[rows].astype(np.int64)),
                        lists,
                    ],
                    names=[*key_cols, "h", "pos", "total", "slots"],
                )

    narrow = table.select(*key_cols, F.col(text_col).cast("string").alias("_text"))
    kinds = "".join(f"{c} {narrow.schema[c].dataType.simpleString()}, " for c in key_cols)
    return narrow.mapInArrow(run, f"{kinds}h bigint, pos bigint, total bigint, slots array<bigint>")


def _filter_bits(windows: DataFrame) -> np.ndarray:
    """A bit for each prefix of a window hash: 2 MB whatever the number of windows, as 32-bit words with a bit set."""
    place = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    words = windows.select((place / 32).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 32).cast("int")).alias("b"))
    rows = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(1 << (FILTER_BITS - 5), "<u4")
    bits[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).astype("<u4")
    return bits.view(np.uint8)


def _longest_run(places: Column) -> Column:
    """The longest run of consecutive numbers in a sorted array."""
    start = F.struct(F.lit(-2).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("best"))

    def step(done, p):
        run = F.when(p == done["last"] + 1, done["run"] + 1).otherwise(F.lit(1).cast("bigint"))
        return F.struct(p.alias("last"), run.alias("run"), F.greatest(done["best"], run).alias("best"))

    return F.aggregate(places, start, step, lambda done: done["best"])


def _candidates(found: DataFrame, items: DataFrame, window: int, share: float, run: int) -> DataFrame:
    """``(doc_id, text_hash, item_id)`` of all pairs that can reach ``share`` or ``run``.

    Such a pair has at least ``need`` places of the item in common: its share of them, or those of a run.  So of each item
    the ``need - 1`` places whose windows most items have open no pair, and one of the others must still be met.  A
    phrase that many items and many documents use does not bring each of these items together with each document.
    """
    many = items.groupBy("h").agg(F.count_distinct(F.struct("item_id")).alias("items"))
    places = items.join(many, "h").groupBy("item_id", "pos").agg(F.max("items").alias("items"), F.max("total").alias("total"))
    of_item = Window.partitionBy("item_id")
    total = F.max("total").over(of_item)
    need = F.greatest(F.lit(1), F.least(F.ceil(total * F.lit(share) - F.lit(1e-9)), F.lit(run - window + 1)))
    place = F.row_number().over(of_item.orderBy(F.desc("items"), "pos"))
    opens = places.withColumn("opens", (place >= need) | (F.col("items") == 1)).where("opens")
    opens = opens.select(F.col("item_id").alias("of_item"), F.col("pos").alias("of_pos"))
    active = items.join(opens, items["item_id"].eqNullSafe(F.col("of_item")) & (F.col("pos") == F.col("of_pos")), "left_semi")
    return found.select("doc_id", "text_hash", "h").join(active.select("h", "item_id").distinct(), "h").drop("h").distinct()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: float = SHARE,
    run: int = RUN,
    literals: int = LITERALS,
    stretch: int = STRETCH,
    units: list[str] = UNITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, text_hash, item_id, share, run, changed_slots`` of documents that hold a benchmark item or most of it.

    Texts become templates, of which windows of ``window`` tokens are joined by hash.  A window with fewer than
    ``literals`` words outside slots is lengthened until it has them, so that questions full of numbers are compared; one
    that would be ``stretch`` times as long is left out on both sides.  Windows on one alignment of a
    document with an item must be consistent: a word in a slot of the item stands for one word of the document
    throughout, else only windows without slots count there.  A window with slots is also compared word for word.
    ``share`` is the part of the item's windows found on any alignment, ``run`` the longest stretch of tokens found in a
    row; a pair is returned if ``share`` reaches its threshold, or ``run`` its own.  ``changed_slots`` counts slot words
    that differ: 0 is a plain copy, more is a question with other numbers, names or ``units``.

    One pass over the texts writes the windows whose hash prefix a bit table of 2 MB knows; these few choose the pairs to
    compare (``_candidates``), and windows of these pairs alone are joined.

    Defined cases: null or short texts and items have no windows and match nothing; rows are told apart by id and a
    hash of the text, so repeated rows count once and null ids are found, too; an item id that occurs again is
    one item with both texts' windows; other columns are ignored; empty tables give no rows.
    """
    form = {"window": window, "literals": literals, "stretch": stretch, "units": units}
    asked = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("_item"))
    items = staged(template_windows(asked, ["item_id"], "_item", **form), "items")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).alias("_doc"))
    found = staged(template_windows(texts, ["doc_id", "text_hash"], "_doc", **form, bits=_filter_bits(items)), "windows")
    known = items.select(F.col("item_id").alias("of_item"), "total", F.col("h").alias("of_h"), F.col("pos").alias("at"), F.col("slots").alias("asked"))
    near = _candidates(found, items, window, share, run)
    near = near.join(known, F.col("item_id").eqNullSafe(F.col("of_item")))
    near = near.withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_text"}).drop("of_item")
    same = F.col("of_doc").eqNullSafe(F.col("doc_id")) & (F.col("of_text") == F.col("text_hash")) & (F.col("of_h") == F.col("h"))
    pair = F.zip_with("asked", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    met = near.join(found.drop("total"), same).select(
        "doc_id", "text_hash", "item_id", "total", (F.col("pos") - F.col("at")).alias("shift"), F.struct("at", pair.alias("pairs")).alias("w")
    )
    aligned = met.groupBy("doc_id", "text_hash", "item_id", "shift").agg(F.max("total").alias("total"), F.collect_set("w").alias("w"))
    pairs = F.array_distinct(F.flatten(F.transform("w", lambda w: w["pairs"])))
    aligned = aligned.withColumn("pairs", pairs).withColumn(
        "steady", F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"])))
    )
    counted = F.filter("w", lambda w: F.col("steady") | (F.size(w["pairs"]) == 0))
    places = F.array_sort(F.array_distinct(F.transform(counted, lambda w: w["at"])))
    aligned = aligned.withColumn("places", places).where("size(places) > 0").withColumn("run", _longest_run(F.col("places")) + window - 1)
    changed = F.when(F.col("steady"), F.size(F.filter("pairs", lambda p: p["a"] != p["b"]))).otherwise(0)
    items_of = aligned.withColumn("changed", changed).groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("total").alias("total"),
        F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"),
        F.max("run").alias("run"),
        F.max(F.struct(F.size("places").alias("n"), F.col("changed"))).alias("best"),
    )
    part = F.least(F.lit(1.0), F.size("places") / F.col("total"))
    return items_of.select(
        "doc_id", "text_hash", "item_id", part.alias("share"), "run", F.col("best.changed").cast("long").alias("changed_slots")
    ).where((F.col("share") >= share) | (F.col("run") >= run))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns, whatever their names.

    What is found is written first, so it can be counted: while it is small it is broadcast and no text is shuffled.
    """
    bad = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    bad = staged(bad.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_text")).distinct(), "bad")
    names = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))
    text, own = F.col(f"c{names.index(text_col)}"), F.col(f"c{names.index(id_col)}")
    same = (F.xxhash64(text.cast("string")) == F.col("bad_text")) & own.eqNullSafe(F.col("bad_id"))
    kept = rows.join(small_side(bad), same, "left_anti")
    return kept.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))
