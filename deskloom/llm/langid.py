"""Language identification by compression.

Every language gets a zstandard raw-content dictionary: text of that language. A text is encoded with each of them; the
language whose dictionary makes it smallest wins. Where the best two sizes lie close together the text is rejected.
"""

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.llm.words import release

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
RESULT = "lang_pred string, score double, margin double, rejected boolean"
NOT_LETTERS = bytes(range(97)) + bytes(range(123, 128))
BLANKS = bytes.maketrans(NOT_LETTERS, b" " * len(NOT_LETTERS))


@dataclass(frozen=True)
class LanguageModel:
    """Dictionary bytes per language, and how texts are encoded with them."""

    dictionaries: dict[str, bytes]
    level: int = 5
    chunk: int = 8192
    min_margin: float = 0.005
    documents: dict[str, int] = field(default_factory=dict)  # how many documents each dictionary has text of


def plain_letters(text: str) -> bytes:
    """Lower-case UTF-8 text in which every run of ASCII characters other than letters is one blank."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(BLANKS).split())


def has_letter(text: str) -> bool:
    return re.search("[A-Za-z]", text) is not None or any(map(str.isalpha, text))


def slices_of_all(texts: list[tuple[int, bytes]], room: int) -> list[bytes]:
    """A slice of each (spot, text), so long that all of them and the blanks between them fit ``room`` bytes: short texts are
    whole, longer ones are cut to the same length at a place that the spot tells."""
    room -= len(texts) - 1
    longest = 0
    for k, size in enumerate(sorted(len(t) for _, t in texts)):
        longest = max(1, room // (len(texts) - k))
        room -= min(size, longest)
    starts = (spot % max(1, len(t) - longest + 1) for spot, t in texts)
    return [t[a:a + longest] for a, (_, t) in zip(starts, texts)]


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  docs_per_lang: int = 300, chars_per_doc: int = 2000, dict_bytes: int = 112_640,
                  **settings) -> LanguageModel:
    """One dictionary per language, from a bounded sample of labelled rows.

    The sample is ``docs_per_lang`` documents of each language, smallest hash of the id first. A slice from a hashed place
    of each teaches, at most ``chars_per_doc`` characters and so long that all fit the ``dict_bytes`` of a dictionary. Rows without language, id or text teach nothing; a
    language without any letters in its sample is not learned.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    order = F.xxhash64("id")
    first = Window.partitionBy("lang").orderBy("order", "id")
    chosen = (rows.select("id", "lang", order.alias("order")).filter("id IS NOT NULL AND lang IS NOT NULL").distinct()
              .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= docs_per_lang))
    spot = F.pmod(F.xxhash64("lang", "id"), F.lit(1 << 31))
    begin = 1 + F.pmod(spot, F.greatest(F.lit(1), F.length("text") - chars_per_doc + 1)).cast("int")
    sample = rows.join(F.broadcast(chosen), ["id", "lang"]).select(
        "lang", "place", spot.alias("spot"), F.substring("text", begin, F.lit(chars_per_doc)).alias("text")).filter("text IS NOT NULL")
    texts: dict[str, list] = {}
    for row in sample.collect():
        texts.setdefault(row["lang"], []).append((row["place"], row["spot"], plain_letters(row["text"])))
    found, documents = {}, {}
    for lang, of in sorted(texts.items()):
        full = [(place, spot, text) for place, spot, text in sorted(set(of)) if text]
        content = b" ".join(slices_of_all([t[1:] for t in full], dict_bytes)).strip()[:dict_bytes]
        if len(content) >= 8:
            found[lang], documents[lang] = content, len({place for place, _, _ in full})
    return LanguageModel(found, documents=documents, **settings)


def _compressors(model: LanguageModel) -> dict:
    made = {}
    for lang, content in model.dictionaries.items():
        prepared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        prepared.precompute_compress(level=model.level)
        made[lang] = zstandard.ZstdCompressor(level=model.level, dict_data=prepared, write_checksum=False,
                                              write_content_size=False, write_dict_id=False)
    return made


def classify(text: str | None, compressors: dict, model: LanguageModel) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected) of one whole text."""
    if text is None or not compressors or not has_letter(text):
        return UNKNOWN, 0.0, 0.0, True
    content = plain_letters(text)
    pieces = [content[i:i + model.chunk] for i in range(0, max(1, len(content)), model.chunk)]
    sizes = {lang: sum(len(c.compress(piece)) for piece in pieces) for lang, c in compressors.items()}
    ranked = sorted((size, lang) for lang, size in sizes.items())
    best = ranked[0][0]
    margin = (ranked[1][0] - best) / ranked[1][0] if len(ranked) > 1 else 1.0
    share = 1.0 / sum(2.0 ** -min(size - best, 1000) for size, _ in ranked)
    return ranked[0][1], share, margin, margin < model.min_margin


def language(text: Column, model: LanguageModel) -> Column:
    """Struct (lang_pred, score, margin, rejected) of each whole text.

    ``lang_pred`` is a learned language, or ``und`` (score 0, rejected) if the text is null, has no letter, or nothing
    was learned. Equal sizes go to the language first in code-point order. ``score`` is the share of the winner when
    each byte saved counts as one bit of evidence; ``margin`` the part by which the second smallest is larger. Texts are
    encoded in chunks, so the dictionaries count over the whole of a long text.
    """

    types = pa.string(), pa.float64(), pa.float64(), pa.bool_()

    @F.arrow_udf(RESULT)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compressors = _compressors(model)
        for batch in batches:
            # Text by text, so a task holds one as a Python string.
            found = zip(*(classify(t.as_py(), compressors, model) for t in batch)) if len(batch) else [()] * len(types)
            yield pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(found, types)],
                                             names=["lang_pred", "score", "margin", "rejected"])
        release()

    return predict(text)
