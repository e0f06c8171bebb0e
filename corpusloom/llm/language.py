"""Language identification by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.splits import held_out

DICTIONARY_BYTES = 256 << 10
SAMPLED = 3_000
EXCERPT = 160
BLOCK = 1 << 10
LEVEL = 3
MARGIN = 0.01
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The lower-case words of a text, in which each run of other characters is one space."""
    return _OTHER.sub(" ", text.lower()).strip()


def learn_dictionaries(
    docs: DataFrame,
    dictionary_bytes: int = DICTIONARY_BYTES,
    sampled: int = SAMPLED,
    excerpt: int = EXCERPT,
    lang_col: str = "lang",
    text_col: str = "text",
) -> dict[str, bytes]:
    """A raw-content dictionary for each language, the most frequent first: excerpts of its texts, one after the other.

    The fit takes a bounded sample: ``excerpt`` characters, at a place that a hash picks, of about ``sampled`` different
    texts of each language, those of the smallest hashes, up to ``dictionary_bytes``.  Many short excerpts keep a passage
    of another language within some text from marking that language.  The hash limit of a language comes from its row
    count; one small table of counts and the excerpts reach the driver.
    """
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    order = sorted(counts, key=lambda lang: (-counts[lang], lang))
    limit = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sampled / n))])[F.col("lang")]
    share = (F.pmod("h", F.lit(1 << 32)) / float(1 << 32)) < limit
    place = F.pmod(F.shiftrightunsigned("h", 32), F.greatest(F.length("text") - excerpt, F.lit(1))) + 1
    part = F.substring("text", place.cast("int"), F.lit(excerpt))
    taken = known.where(share).select("lang", "h", part.alias("text"))
    taken = taken.groupBy("lang", "h").agg(F.min("text").alias("text"))
    texts: dict[str, list[tuple[int, bytes]]] = {lang: [] for lang in counts}
    for row in taken.toLocalIterator():
        texts[row["lang"]].append((row["h"], letters(row["text"]).encode()))
    return {lang: b"\n".join(t for _, t in sorted(texts[lang]))[:dictionary_bytes] for lang in order}


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    margin: float = MARGIN,
    block: int = BLOCK,
    level: int = LEVEL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, lang_pred, score, margin, rejected`` of every text.

    The whole text's ``letters`` are compressed, in blocks of ``block`` bytes, with each language's dictionary; the
    smallest sum wins, ties go to the language that comes first in ``dictionaries``.  ``margin`` is how much smaller it is than the second, as a share of the
    second; ``rejected`` says that this is below the threshold.  ``score`` is ``margin`` mapped to 0.5 to 1 by
    ``1 - 1 / (2 + 50 margin)``, so a tie has 0.5.

    Defined cases: null text, or a text without a letter, is ``und`` with score 0 and rejected; with one language it
    has margin 1; without any language everything is ``und``; repeated rows are kept; no rows give no rows.
    """
    names = list(dictionaries)

    def run(batches):
        import zstandard

        tools = [
            zstandard.ZstdCompressor(
                level=level, dict_data=prepared(dictionaries[n], level), write_content_size=False, write_dict_id=False
            )
            for n in names
        ]
        for batch in batches:
            picked, scores, margins, rejected = [], [], [], []
            for text in batch.column(1).to_pylist():
                data = letters(text or "").encode()
                if not names or not any(map(str.isalpha, text or "")):
                    picked.append(UNKNOWN), scores.append(0.0), margins.append(0.0), rejected.append(True)
                    continue
                pieces = [data[i : i + block] for i in range(0, len(data), block)]
                sizes = [sum(len(t.compress(p)) for p in pieces) for t in tools]
                ranked = sorted(range(len(names)), key=sizes.__getitem__)
                best, second = sizes[ranked[0]], sizes[ranked[1]] if len(ranked) > 1 else 0
                lead = (second - best) / second if second else 1.0
                picked.append(names[ranked[0]])
                scores.append(1 - 1 / (2 + 50 * lead))
                margins.append(lead)
                rejected.append(lead < margin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(picked, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(margins, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    def prepared(content: bytes, at: int):
        import zstandard

        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        if content:
            made.precompute_compress(level=at)
        return made

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, margin double, rejected boolean")


def identify_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out and predict all; adds ``held_out``."""
    learned = learn_dictionaries(docs.where(~held_out(F.col(id_col))), lang_col=lang_col, text_col=text_col)
    found = identify(docs, learned, id_col=id_col, text_col=text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")
