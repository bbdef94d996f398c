"""SentencePiece encoding and decoding by a streaming Viterbi search over the model's piece scores.

The search reads characters one by one. For the positions since the last committed boundary it keeps the best score and
the piece that ends there, and the starts from which a piece may still grow; none of these lies further back than the
longest piece. Any later path leaves from one of these starts or from the end. As soon as the backpointers of all of them
meet in one boundary, the ids before it are committed and forgotten.

A text is one stream. It looks for a boundary after every word mark and every character that no piece holds with others,
and after some number of characters where there are none. Where it finds all paths to meet right before the character
just read, it stands as at its start, so what the next characters yield depends on them alone: the ids between two such
boundaries, both found by the stream, are remembered by the characters read, in a dictionary of bounded size. Only what
follows the last boundary of a text is committed because the text ends (``n_settled`` counts the rest).

The default model is one of byte-pair merges. Its scores are ranks of the merges; the search maximises their sum over
the pieces of a text, as the library does for such scores under its unigram type, and not the order of merges.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlane.llm.common import add_columns

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A vocabulary file above this size is refused: it is broadcast.
MAX_MODEL_BYTES = 64 << 20
#: Segments that a worker remembers, and their length at most; characters after which the stream looks for a boundary.
_REMEMBERED, _REMEMBERED_CHARS, _CHECK_EVERY = 500_000, 64, 64
#: How far below the worst score a character without a piece counts (the public library's value).
UNKNOWN_PENALTY = 10.0


@dataclass
class Vocabulary:
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    surfaces: list[bytes]
    longest: int
    unknown_score: float
    parts: re.Pattern | None
    #: The pieces by their characters: each node has its children, and under None the score of the piece that ends there.
    pieces: dict
    known: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)

    @classmethod
    def of(cls, model: bytes) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids, scores, bytes_, surfaces = {}, {}, [0] * 256, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                bytes_[value] = i
                surfaces.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                surfaces.append(b"")
            else:
                ids[piece], scores[piece] = i, sp.get_score(i)
                surfaces.append(piece.replace(MARK, " ").encode())
        if not any(bytes_):
            raise ValueError("the model has no pieces for single bytes: encoding could lose characters")
        joined = {c for p in ids if len(p) > 1 for c in p}
        cuts = "".join(re.escape(c) for c in "\n\t\r\x0b\x0c" if c not in joined)
        inner = any(MARK in p.lstrip(MARK) for p in ids)
        cut = f"|[{cuts}]" if cuts else ""
        parts = None if inner else re.compile(f"{MARK}*[^{MARK}{cuts}]+|{MARK}+{cut}")
        tree: dict = {}
        for piece, score in scores.items():
            node = tree
            for c in piece:
                node = node.setdefault(c, {})
            node[None] = score
        return cls(ids, scores, bytes_, surfaces, max(map(len, ids)), min(scores.values()) - UNKNOWN_PENALTY, parts, tree)


class Stream:
    """Viterbi search over a stream of characters; ``feed`` and ``finish`` give ids as they become certain.

    Of equally good paths, the one whose last piece starts earliest is kept, at every position.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.widest = 0
        self.restart()

    def restart(self) -> None:
        self.text, self.best, self.back, self.open = "", [0.0], [0], []

    def feed(self, chars: str) -> list[int]:
        out: list[int] = []
        while chars:
            # A look for a boundary after every so many characters of the window.
            some = _CHECK_EVERY - len(self.text) % _CHECK_EVERY
            self._search(chars[:some])
            chars = chars[some:]
            self.widest = max(self.widest, len(self.text))
            if len(self.text) % _CHECK_EVERY == 0 and (boundary := self._converged()):
                out += self._ids(boundary)
                self.text, self.best = self.text[boundary:], self.best[boundary:]
                # Paths that start before the boundary can't be continued any more.
                self.back = [max(0, x - boundary) for x in self.back[boundary:]]
                self.open = [(score, start - boundary, node) for score, start, node in self.open]
        return out

    def finish(self) -> list[int]:
        """The rest of the ids: the stream's end, or a boundary known in advance, is where all paths meet."""
        out = self._ids(len(self.text))
        self.restart()
        return out

    def settled(self) -> list[int] | None:
        """The ids before the last character if all paths meet right there; the stream then stands as before it. Else None."""
        end = len(self.text) - 1
        if self.back[end + 1] != end or any(start < end for _, start, _ in self.open):
            return None
        out = self._ids(end)
        self.restart()
        return out

    def _search(self, chars: str) -> None:
        best, back, growing, root, unknown = self.best, self.back, self.open, self.v.pieces, self.v.unknown_score
        end = len(self.text)
        self.text += chars
        for c in chars:
            growing.append((best[end], end, root))
            end += 1
            top, at, still = None, end - 1, []
            for state in growing:
                node = state[2].get(c)
                if node is not None:
                    so_far, start, _ = state
                    still.append((so_far, start, node))
                    score = node.get(None)
                    if score is not None and (top is None or so_far + score > top):
                        top, at = so_far + score, start
            if top is None:
                top = best[end - 1] + unknown
            growing = still
            best.append(top)
            back.append(at)
        self.open = growing

    def _converged(self) -> int:
        """The last boundary that every path from here on passes through."""
        alive = {len(self.text), *(start for _, start, _ in self.open)}
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(self.back[last])
        return alive.pop()

    def _ids(self, end: int) -> list[int]:
        out: list[int] = []
        ids, text, back = self.v.ids, self.text, self.back
        while end:
            start = back[end]
            number = ids.get(text[start:end])
            if number is not None:
                out.append(number)
            else:
                out += [self.v.byte_ids[b] for b in reversed(text[start:end].encode())]
            end = start
        out.reverse()
        return out


def encode_text(text: str, v: Vocabulary) -> bytes:
    """Little-endian 32-bit ids of a text."""
    return coded(text, v)[0]


def coded(text: str, v: Vocabulary) -> tuple[bytes, int]:
    """Ids, and how many of them were committed at boundaries where all paths met.

    A mark that the text itself holds is encoded by its bytes, so decoding restores it; the stream ends before it.
    """
    if not text:
        return b"", 0
    if MARK not in text:
        return _encoded(MARK + text.replace(" ", MARK), v)
    first, *rest = text.split(MARK)
    mark = np.array([v.byte_ids[b] for b in MARK.encode()], np.int32).tobytes()
    parts = [coded(first, v) if first else _encoded(MARK, v), *(_encoded(p.replace(" ", MARK), v) for p in rest)]
    return mark.join(p for p, _ in parts), sum(n for _, n in parts)


def _encoded(marked: str, v: Vocabulary) -> tuple[bytes, int]:
    """Ids of a stream's characters, fed up to and with the first character after each place where a boundary may be."""
    segments = (v.parts.findall(marked) if v.parts else [marked]) if marked else []
    if not segments:
        return b"", 0
    keys = [s + after[0] for s, after in zip(segments, segments[1:])]
    keys.append(segments[-1])
    found = list(map(v.known.get, keys))
    if None in found:
        found = _streamed(keys, found, v)
    return b"".join(found), sum(map(len, found[:-1])) // 4


def _streamed(keys: list[str], found: list[bytes | None], v: Vocabulary) -> list[bytes]:
    """Ids by key; those that aren't known go through the stream, which stands at a boundary before each."""
    stream = Stream(v)
    for k in [k for k, ids in enumerate(found) if ids is None]:
        key = keys[k]
        ids = v.known.get(key) or v.older.get(key)
        if ids is None:
            fresh = stream.feed(key)
            ended = stream.finish() if k == len(keys) - 1 else stream.settled()
            if ended is None:
                return _unremembered(keys, v)
            ids = array("i", fresh + ended).tobytes()
        if len(key) <= _REMEMBERED_CHARS:
            if len(v.known) >= _REMEMBERED:
                v.known, v.older = {}, v.known
            v.known[key] = ids
        found[k] = ids
    return found


def _unremembered(keys: list[str], v: Vocabulary) -> list[bytes]:
    """Ids by key from one stream over all of them: paths didn't meet after one, so its ids come with a later one."""
    stream, out, met = Stream(v), [], True
    for key in keys[:-1]:
        ids = array("i", stream.feed(key if met else key[1:]))
        ended = stream.settled()
        met = ended is not None
        ids.extend(ended or [])
        out.append(ids.tobytes())
    rest = array("i", stream.feed(keys[-1] if met else keys[-1][1:]))
    rest.extend(stream.finish())
    return [*out, rest.tobytes()]


def decode_ids(ids: bytes, v: Vocabulary) -> str:
    numbers = np.frombuffer(ids, np.int32).tolist()
    return b"".join(map(v.surfaces.__getitem__, numbers)).decode("utf-8", "replace").removeprefix(" ")


def read_model(spark, path: str) -> bytes:
    """The vocabulary file: from the driver's disk, or by Spark if the path names a store; refused above ``MAX_MODEL_BYTES``."""
    if "://" not in path:
        if os.path.getsize(path) > MAX_MODEL_BYTES:
            raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
        with open(path, "rb") as file:
            return file.read()
    row = spark.read.format("binaryFile").load(path).filter(f"length <= {MAX_MODEL_BYTES}").select("content").first()
    if row is None:
        raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
    return bytes(row[0])


def _shared(spark, path: str):
    return spark.sparkContext.broadcast(read_model(spark, path))


_VOCABULARIES: dict[bytes, Vocabulary] = {}


def _vocabulary(model: bytes) -> Vocabulary:
    """One per worker process and model."""
    key = hashlib.sha256(model).digest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary.of(model)
    return _VOCABULARIES[key]


def encode(docs: DataFrame, model_path: str = DEFAULT_MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` with ids (array of int), n_tokens, round_trip (decoding gives the text); columns of the same names are replaced.

    Null and empty texts have no ids. Texts are taken as they are: nothing is normalised, so decoding restores them.
    Repeated rows are coded one by one, alike; ids of documents may be of any type.
    """
    model = _shared(docs.sparkSession, model_path)

    def work(batches):
        v = _vocabulary(model.value)
        for b in batches:
            texts = [t or "" for t in b[text_col].to_pylist()]
            coded = [encode_text(t, v) for t in texts]
            same = [decode_ids(i, v) == t for i, t in zip(coded, texts, strict=True)]
            sizes = np.array([len(x) // 4 for x in coded], np.int64)
            flat = pa.array(np.frombuffer(b"".join(coded), np.int32))
            yield {"ids": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat), "n_tokens": pa.array(sizes), "round_trip": same}

    return add_columns(docs, [text_col], T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]), work)


def decode(coded: DataFrame, model_path: str = DEFAULT_MODEL, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """``coded`` with the text of the ids as column ``to``; null ids give an empty text."""
    model = _shared(coded.sparkSession, model_path)

    def work(batches):
        v = _vocabulary(model.value)
        for b in batches:
            yield {to: [decode_ids(np.array(i or [], np.int32).tobytes(), v) for i in b[ids_col].to_pylist()]}

    return add_columns(coded, [ids_col], T.StructType([T.StructField(to, T.StringType())]), work)


def digest(docs: DataFrame, model_path: str = DEFAULT_MODEL, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encodes and decodes each text in one pass: the id, n_tokens, n_byte_tokens, n_settled, ids_sha256, decoded_sha256, round_trip."""
    model = _shared(docs.sparkSession, model_path)
    new = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_byte_tokens", T.LongType()), T.StructField("n_settled", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())])

    def work(batches):
        v = _vocabulary(model.value)
        single = np.zeros(len(v.surfaces), bool)
        single[v.byte_ids] = True
        for b in batches:
            out = []
            texts = b[text_col].to_pylist()
            for t in texts:
                ids, settled = coded(t or "", v)
                decoded = decode_ids(ids, v)
                out.append((len(ids) // 4, int(single[np.frombuffer(ids, np.int32)].sum()), settled, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), decoded == (t or "")))
            yield {f.name: list(c) for f, c in zip(new, zip(*out, strict=True) if out else [()] * len(new), strict=True)}

    return add_columns(docs.select(id_col, text_col), [text_col], new, work).drop(text_col)
