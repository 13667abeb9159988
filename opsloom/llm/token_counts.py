"""Token counts: Arrow functions that return lengths only."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opsloom.llm.common import map_batches, text_bytes

# Bytes of text encoded in one call: calls cost alike whatever the lengths of the texts.
CALL_BYTES = 1 << 18
# Counted fragments a worker remembers before it starts afresh.
REMEMBERED = 1 << 19

# A byte-level pre-tokenizer never joins a printable ASCII character to white space after it, and
# it looks at nothing before its place, so a text may be cut there without changing a token.
_SAFE = re.compile(r"(?<=[!-~])(?=[ \n\t\r])")

# Fixed value: how byte-level tokenizers split a text before merging.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters whose classes are the same in every version of Unicode a library may hold.
_SETTLED = re.compile("[\x00-\u024f]*")


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself if it is visible, else as U+0100 and so on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _ranks(model: dict) -> dict[bytes, int] | None:
    """Ranks of the same merges, if ids rise with the order of the merges; else None."""
    letters = _byte_of_letter()
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if set(token) <= letters.keys()}
    order = []
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        order.append(model["vocab"][left + right])
    return ranks if order == sorted(order) and len(set(order)) == len(order) else None


@lru_cache(maxsize=2)
def _counters(definition: str) -> tuple[Callable[[list[str]], list[int]], Callable[[str], int] | None, tuple[str, ...]]:
    """The library's batch count, a quicker count by ranks where it is the same, special strings."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    parsed = json.loads(definition)
    special = tuple(t["content"] for t in parsed["added_tokens"])

    def batch(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    split = parsed["pre_tokenizer"]
    plain = split == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} | {
        k: v for k, v in split.items() if k == "trim_offsets"
    }
    if not plain or parsed["normalizer"]:
        raise ValueError("the tokenizer must be byte-level, without normalizer and without an added space")
    ranks = _ranks(parsed["model"])
    if ranks is None or parsed["model"].get("ignore_merges"):
        return batch, None, special
    encoding = tiktoken.Encoding("counts", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
    return batch, lambda text: len(encoding.encode_ordinary(text)), special


_KNOWN: dict[int, dict[str, int]] = {}


def _learn(definition: str, missing: list[str], known: dict[str, int]) -> None:
    """Count the missing fragments; those the ranks may not hold for go to the library in even calls."""
    batch, quick, special = _counters(definition)
    call: list[str] = []
    size = 0

    def flush() -> None:
        known.update(zip(call, batch(call), strict=True))

    for fragment in missing:
        if quick and _SETTLED.fullmatch(fragment) and not any(s in fragment for s in special):
            known[fragment] = quick(fragment)
            continue
        call.append(fragment)
        size += len(fragment)
        if size >= CALL_BYTES:
            flush()
            call, size = [], 0
    flush()


def count_tokens(frame: DataFrame, definition: str, *, text: str = "text", limit: int = 1024) -> DataFrame:
    """``frame`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``definition`` is the JSON text of a byte-level tokenizer of the tokenizers library without
    normalizer and without an added leading space. Counts are those of the library without begin,
    end or added special tokens; special strings inside a text count as the library's default
    treats them. Null and empty texts have no tokens. Other columns are kept; columns of the
    three names are replaced. Repeated rows are counted alike.
    """
    spark = frame.sparkSession
    shared = spark.sparkContext.broadcast(definition)
    kept = [c for c in frame.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    source = frame.select(*(f"`{c}`" for c in kept))
    place = kept.index(text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _KNOWN.setdefault(hash(shared.value), {})
        for batch in batches:
            column = batch.column(place)
            pieces = [_SAFE.split(t) if t else [] for t in column.to_pylist()]
            missing = list({f for parts in pieces for f in parts if f not in known})
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
                missing = list({f for parts in pieces for f in parts})
            _learn(shared.value, missing, known)
            tokens = np.array([sum(map(known.__getitem__, parts)) for parts in pieces], np.int64)
            _, offsets = text_bytes(column)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                names=[*kept, "n_bytes", "n_tokens", "over_limit"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    return map_batches(source, count, ", ".join([*fields, "n_bytes long", "n_tokens long", "over_limit boolean"]))
