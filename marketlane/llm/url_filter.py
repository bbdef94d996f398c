"""URL rules by a bit-parallel wildcard automaton.

Rules are globs over a canonical URL. All of them are packed into multiword Shift-And masks: a bit for each literal
symbol of each glob, a self-loop wherever a ``*`` stands. One step per symbol moves every glob at once, for a whole
column of URLs; URLs that have ended drop out of the columns.

Rules with a verdict of their own decide first, the longest one that fits. What they leave open is decided by the
method's list: globs with inner stars over hosts that only count or advertise and paths that are no texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlane.llm.common import LOWER, add_columns

#: The symbol between host and path in a canonical URL; it is no byte, so no host or path can hold it.
BORDER, STAR, ALPHABET = 256, -1, 257


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``. Both may hold ``*``, which stays inside its part."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def symbols(self) -> list[int]:
        """``*.host|path*`` over the canonical URL ``.host|path``."""
        part = lambda s: [STAR if c == 0x2A else c for c in s.encode()]
        return [STAR, 0x2E, *part(self.host), BORDER, *part(self.path), STAR]


#: The rules of the query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
#: The method's list is every word in every form: hosts that advertise or count, pages for machines, visitors and sessions.
HOST_WORDS = "ads adserver banner beacon click counter metrics pixel stats track tracker".split()
#: Words are whole labels, or whole parts of one between hyphens, before a domain: countertop-shop.com is no counter.
HOST_FORMS = ("{}.*.*", "{}-*.*.*", "*-{}.*.*")
PATH_WORDS = (
    "account admin ajax basket calendar callback captcha cart checkout comment-reply compare cookie cgi-bin debug "
    "feed forgot-password login logout oauth order-status password ping plugin popup preferences print proxy redirect "
    "register rss session share signin signup sitemap subscribe tag trackback unsubscribe upload wishlist wp-admin xmlrpc"
).split()
PATH_FORMS = ("/{}/", "/*/{}/*", "/*/{}.*", "/*;*{}=")
METHOD = tuple(Rule(form.format(word), "/", "block") for word in HOST_WORDS for form in HOST_FORMS) + tuple(Rule("*", form.format(word), "block") for word in PATH_WORDS for form in PATH_FORMS)
COLUMNS = T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict", "glob")])


class ShiftAnd:
    """Simulates all globs at once over arrays of symbols."""

    def __init__(self, globs: list[list[int]]) -> None:
        literals = [[c for c in g if c != STAR] for g in globs]
        bits = sum(len(x) for x in literals)
        self.words = max(1, -(-bits // 64))
        self.masks = np.zeros((ALPHABET, self.words), np.uint64)
        self.begin, self.again = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        # Globs that start with a star may begin at any symbol, the others at the first one only. A star between two
        # literals holds its place at any symbol but the border; a last star holds it at every symbol.
        self.anywhere, self.inner = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.last: list[int] = []
        at = 0
        for glob in globs:
            begin = at
            for k, c in enumerate(glob):
                if c == STAR:
                    if at == begin:
                        self._set(self.anywhere, at)
                    elif k == len(glob) - 1:
                        self._set(self.again, at - 1)
                    else:
                        self._set(self.inner, at - 1)
                else:
                    if at == begin:
                        self._set(self.begin, at)
                    self.masks[c, at // 64] |= np.uint64(1) << np.uint64(at % 64)
                    at += 1
            self.last.append(at - 1)
        self.starts = self.begin.copy()

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def match(self, texts: list[np.ndarray]) -> np.ndarray:
        """Which glob (column) matches which text (row) as a whole."""
        return self._matched(self._states(texts), np.arange(len(self.last)))

    def first(self, texts: list[np.ndarray], ranked: list[int], at_once: int = 4096) -> np.ndarray:
        """Of each text the first glob of ``ranked`` that matches it, or -1; as many globs are looked at together as ``at_once`` says."""
        state, out = self._states(texts), np.full(len(texts), -1, np.int64)
        for k in range(0, len(ranked), at_once):
            some, open_ = np.array(ranked[k : k + at_once]), np.flatnonzero(out < 0)
            hits = self._matched(state[open_], some)
            any_ = hits.any(axis=1)
            out[open_[any_]] = some[hits[any_].argmax(axis=1)]
        return out

    def _matched(self, state: np.ndarray, globs: np.ndarray) -> np.ndarray:
        bit = np.array(self.last, np.int64)[globs]
        return (state[:, bit // 64] >> (bit % 64).astype(np.uint64)) & np.uint64(1) == 1

    def _states(self, texts: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        state = np.zeros((len(texts), self.words), np.uint64)
        top, one = np.uint64(63), np.uint64(1)
        ascending = np.sort(lengths)
        for t in range(int(lengths.max(initial=0))):
            live = order[: len(texts) - int(np.searchsorted(ascending, t, "right"))]
            symbol, now = flat[offsets[live] + t], state[live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved &= ~self.starts
            moved |= (self.begin & self.anywhere) if t else self.begin
            moved &= self.masks[symbol]
            moved |= now & self.again
            moved |= np.where((symbol == BORDER)[:, None], np.uint64(0), now & self.inner)
            state[live] = moved
        return state


def parts_of(url: bytes) -> tuple[bytes, bytes]:
    """Host (lower-cased) and path; both empty without ``://``."""
    _, mark, rest = url.partition(b"://")
    if not mark:
        return b"", b""
    end = min((i for i in (rest.find(c) for c in (b"/", b"?", b"#")) if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in (path.find(c) for c in (b"?", b"#")) if i >= 0), default=len(path))
    return rest[:end].translate(LOWER), path[:stop]


#: URLs that the automaton takes at once.
URLS_AT_ONCE = 2048


def ranking(rules: tuple[Rule, ...]) -> list[int]:
    """Longest first; of equally long ones, one that blocks, and then the first given."""
    return sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), rules[i].verdict != "block", i))


def url_filter(pages: DataFrame, rules: tuple[Rule, ...] = RULES, method: tuple[Rule, ...] = METHOD, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and glob; columns of the same names are replaced.

    The longest of ``rules`` that fits decides. Without any, rule is null, and the longest glob of ``method`` that fits
    decides and is named as ``glob``; without that, too, glob is null and verdict is ``default``. A null or empty url, or
    one without ``://``, has empty parts and fits none. URLs of any length are read to their end; repeated rows are
    judged alike, and ids play no part.
    """
    both = (*rules, *method)
    ranked = [*ranking(rules), *(len(rules) + i for i in ranking(method))]

    def work(batches):
        automaton = ShiftAnd([r.symbols() for r in both])
        for b in batches:
            parts = [parts_of((u or "").encode()) for u in b[url_col].to_pylist()]
            best: list[int] = []
            for k in range(0, len(parts), URLS_AT_ONCE):
                texts = [np.concatenate((np.frombuffer(b"." + h, np.uint8).astype(np.int64), [BORDER], np.frombuffer(p, np.uint8))) for h, p in parts[k : k + URLS_AT_ONCE]]
                best += automaton.first(texts, ranked).tolist()
            own = [i < len(rules) for i in best]
            yield {
                "host": [h.decode() for h, _ in parts],
                "path": [p.decode() for _, p in parts],
                "rule": [both[i].name if i >= 0 and o else None for i, o in zip(best, own, strict=True)],
                "verdict": [both[i].verdict if i >= 0 else default for i in best],
                "glob": [both[i].name if i >= 0 and not o else None for i, o in zip(best, own, strict=True)],
            }

    return add_columns(pages, [url_col], COLUMNS, work)
