"""Language identification with bit-sliced Bloom filters over byte n-grams.

Slot ``s`` of the filter holds one bit per language. The bits of a gram's slots, combined by AND,
are the languages that (may) contain the gram, found for all languages at once. A text is decided
by the number of its grams each language contains, less those a filter of that fill would return
by accident.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import _LOWER, finish, map_batches, mix, text_bytes

UNKNOWN = "und"
# Lengths of the grams, in bytes of lower-cased text where other ASCII than letters is a blank.
GRAMS = (2, 3, 4)
# A gram belongs to a language if it makes up this share of that language's grams of its length;
# so a language has at most len(GRAMS) / MIN_SHARE grams, however large the corpus.
MIN_SHARE = 2e-5
SLOTS = 1 << 21
PROBES = 4
# Distinct grams a task gathers before it hands their counts on.
HELD_GRAMS = 1 << 19

_BLANK = 0x20
_PLAIN = _LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = _BLANK


def text_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed grams, the text of each and its length; a gram of blanks only is left out."""
    raw, offsets = text_bytes(column)
    # A blank before and after each text, so that its first and last letters are seen as such.
    rows = len(offsets) - 1
    data = np.full(len(raw) + 2 * rows, _BLANK, np.uint8)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    data[np.arange(len(raw)) + 2 * owner + 1] = _PLAIN[raw]
    text = np.repeat(np.arange(rows), np.diff(offsets) + 2)
    wide = data.astype(np.uint64)
    packed, owners, lengths = [], [], []
    gram = wide
    for size in range(2, max(GRAMS) + 1):
        gram = (gram[:-1] << np.uint64(8)) | wide[size - 1 :]
        if size in GRAMS:
            whole = text[: len(gram)] == text[size - 1 :]
            # Of the blanks between words one is enough: skip grams that start with two.
            whole &= (data[: len(gram)] != _BLANK) | (data[1 : len(gram) + 1] != _BLANK)
            packed.append(gram[whole] | np.uint64(size << 56))
            owners.append(text[: len(gram)][whole])
            lengths.append(np.full(int(whole.sum()), size, np.int8))
    return np.concatenate(packed), np.concatenate(owners), np.concatenate(lengths)


def has_letter(column: pa.Array) -> np.ndarray:
    """True for texts with a letter of any script."""
    raw, offsets = text_bytes(column)
    total = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_PLAIN[raw] < 128, out=total[1:])
    ascii_letter = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((_PLAIN[raw] != _BLANK) & (raw < 128), out=ascii_letter[1:])
    found = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return found


@dataclass(frozen=True)
class LanguageFilters:
    languages: tuple[str, ...]
    slots: np.ndarray  # SLOTS x words of 64 language bits
    accident: np.ndarray  # per language: chance that a gram outside the filter seems inside

    def counts(self, grams: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """Per text and language: how many grams the language's filter returns."""
        found = self.slots[_probe(grams, 0)]
        for i in range(1, PROBES):
            found &= self.slots[_probe(grams, i)]
        hits = np.empty((rows, len(self.languages)))
        for k in range(len(self.languages)):
            inside = (found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            hits[:, k] = np.bincount(owner, weights=inside, minlength=rows)
        return hits


def _probe(grams: np.ndarray, i: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(grams, np.uint64(0x51ED270B * (i + 1))) & np.uint64(SLOTS - 1)).astype(np.int64)


def fit_languages(frame: DataFrame, *, text: str = "text", lang: str = "lang") -> LanguageFilters:
    """Filters learnt from every text with a language; no such rows give no languages."""
    source = frame.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )

    def emit(held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for name, parts in held.items():
            grams, counts = _summed(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            distinct = sorted(set(names))
            code = np.array([distinct.index(n) for n in names]) if len(distinct) < 64 else np.searchsorted(distinct, names)
            grams, owner, _ = text_grams(batch.column(1))
            for k, name in enumerate(distinct):
                g, c = np.unique(grams[code[owner] == k], return_counts=True)
                held.setdefault(name, []).append((g, c.astype(np.int64)))
                size += len(g)
            if size > HELD_GRAMS:
                held = {name: [_summed(parts)] for name, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD_GRAMS // 2:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    counts = map_batches(source, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("size", F.shiftrightunsigned("gram", 56))
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    # Both sides may be large in principle; the rows kept are bounded by MIN_SHARE per language.
    members = counts.join(totals, ["lang", "size"]).where(F.col("n") >= F.col("total") * MIN_SHARE)
    rows = members.select("lang", "gram").toArrow()
    names = rows.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    place = {name: i for i, name in enumerate(languages)}
    slots = np.zeros((SLOTS, max(1, -(-len(languages) // 64))), np.uint64)
    grams = rows.column("gram").to_numpy().astype(np.uint64)
    code = np.array([place[n] for n in names], np.int64)
    accident = np.zeros(len(languages))
    for k in range(len(languages)):
        own = grams[code == k]
        taken = np.unique(np.concatenate([_probe(own, i) for i in range(PROBES)]))
        slots[taken, k // 64] |= np.uint64(1 << (k % 64))
        accident[k] = (len(taken) / SLOTS) ** PROBES
    return LanguageFilters(languages, slots, accident)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([c for _, c in parts]))
    return grams, counts.astype(np.int64)


def predict_language(frame: DataFrame, model: LanguageFilters, *, text: str = "text") -> DataFrame:
    """``frame`` with ``lang_pred`` and ``score``, the corrected share of grams the language contains.

    Null texts, texts without a letter, and all texts of a model without languages are ``und`` with
    score 0. Ties go to the first language in alphabetical order. Other columns are kept; columns
    of the two names are replaced.
    """
    kept = [c for c in frame.columns if c not in ("lang_pred", "score")]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    place = kept.index(text)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        names = np.array([*filters.languages, UNKNOWN], object)
        for batch in batches:
            column, rows = batch.column(place), batch.num_rows
            known = has_letter(column)
            best, score = np.full(rows, len(names) - 1), np.zeros(rows)
            if filters.languages:
                grams, owner, _ = text_grams(column)
                n = np.bincount(owner, minlength=rows).astype(np.float64)[:, None]
                hits = filters.counts(grams, owner, rows)
                share = (hits - n * filters.accident) / np.maximum(n * (1 - filters.accident), 1)
                best = np.where(known, share.argmax(axis=1), best)
                score = np.where(known, np.clip(share.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    return map_batches(source, predict, ", ".join([*fields, "lang_pred string", "score double"]))
