"""Words of whole texts as numbers, for operators that count words or look them up: split by Arrow, no loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marketlane.llm.common import LOWER


def byte_map(apart: bytes, ends: bytes = b"") -> bytes:
    """A table for ``bytes.translate``: A-Z lower-cased, the bytes ``apart`` a blank and the bytes ``ends`` a line feed."""
    out = bytearray(LOWER)
    for x in apart:
        out[x] = 0x20
    for x in ends:
        out[x] = 0x0A
    return bytes(out)


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between blanks: the text each stands in, its number, and the words by number (every one occurs)."""
    parts = pc.split_pattern(pa.array(texts, pa.large_binary()), b" ")
    coded = pc.list_flatten(parts).dictionary_encode()
    text = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    number, words = coded.indices.to_numpy(), coded.dictionary
    if (blank := words.index(b"").as_py()) >= 0:
        full = number != blank
        text, number = text[full], number[full]
        number = np.where(number > blank, number - 1, number)
        words = pa.concat_arrays([words.slice(0, blank), words.slice(blank + 1)])
    return text, number, words


def cut(blob: bytes, size: int, at: bytes = b"\n") -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end at ``at``; one without it is whole, whatever its size."""
    begin = 0
    while len(blob) - begin > size:
        end = blob.rfind(at, begin, begin + size)
        end = end if end > begin else blob.find(at, begin + size)
        if end < 0:
            break
        yield blob[begin:end]
        begin = end + len(at)
    yield blob[begin:]
