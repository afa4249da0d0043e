"""Fill-in-the-middle: a text is cut into prefix, middle and suffix and written in another order between markers.

One match of ``(unit)*`` over the whole text keeps the end of every repetition, so its list of ends holds the number of
units and every place where the text may be cut. Cuts and forms are drawn from a hash of seed and id: reruns agree.
"""

import hashlib
import sys
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.words import slices

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# A word with the blanks before it, or the blanks at the end. Nothing that a unit took is given back.
UNITS = r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+"


@dataclass(frozen=True)
class Infill:
    seed: int = 42
    changed_percent: int = 50  # of the texts that are not empty and hold no marker
    spm_percent: int = 80      # of the changed texts; the others are psm


def draws(seed: int, doc_id) -> list[int]:
    """Four 32-bit numbers of (seed, id); a null id counts as the empty text."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(key.encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def arranged(text: str, drawn: list[int], units, rules: Infill) -> tuple:
    """(n units, form, prefix length, middle length, output); lengths in code points, null if the form is plain."""
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or drawn[2] % 100 >= rules.changed_percent:
        return n, "plain", None, None, text
    first, last = (ends[k - 1] if k else 0 for k in sorted((drawn[0] % (n + 1), drawn[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if drawn[3] % 100 < rules.spm_percent:
        return n, "spm", first, last - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, last - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Infill = Infill()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars, output.

    A null text counts as empty and is plain with n = 0. Rows that repeat an id are drawn alike, each with its own text;
    a null id draws as the empty text does. A cut may leave any of the three parts empty. Other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def rearrange(batches):
        units = regex.compile(UNITS)
        for part in slices(batches):
            ids = part.column(0).to_pylist()
            found = [arranged(t or "", draws(rules.seed, i), units, rules) for i, t in zip(ids, part.column(1).to_pylist())]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(list(c), k) for c, k in zip(zip(*found), kinds))],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(rearrange, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                      "output string")


def _after(text: Column, head: Column, marker: str) -> Column:
    return F.substring(text, F.length(head) + len(marker) + 1, F.length(text))


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` has put into this form; a null output gives null, an unknown form the output itself.

    A changed text holds no marker, and a marker cannot overlap with the text around it, so the first of each is the right one.
    """
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, len(first) + 1, F.length(output))
        one = F.substring_index(rest, second, 1)
        rest = _after(rest, one, second)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, _after(rest, two, MIDDLE)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
