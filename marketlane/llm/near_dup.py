"""MinHash near-dedup as a Chosen-Path set similarity join.

1. Documents become sets of word shingles; equal sets form one class, named by 64 bits of their fingerprint, so exact
   copies cost one row each.
2. A tree sends every class from its root down ``START`` levels. A node chooses some of the minwise tokens (the same for
   all who are there) and a class goes on to the child named by its value of each. Nodes that a sample of the classes
   shows to be large branch again, down to ``MAX_DEPTH``; all of that happens in one pass before the one shuffle by node.
   Nodes that are still large at the last level are dealt into blocks. Within its task, a node with more than
   ``node_limit`` classes branches on by the bytes of the sketches; what is small is compared exhaustively.
3. The first tree only looks for one or two partners of each class: the smallest one that is surely alike, and the most
   alike one. They are confirmed on full sets and give components. The other trees, independent of it, state all likely
   pairs of different components, which are confirmed in turn. So a group in which everything is alike costs some rows
   for each member and not one for each two.
4. A node with more such pairs than ``PARTNERS`` for each class, or one that was dealt into blocks, is only named if it
   has several components. Its members then meet once more with their full sets, in blocks: a set moves once for each
   block, however many pairs it is in.

Two classes at similarity 0.8 share no small node of the four full trees about once in 10**5; if all of their nodes
branch on to ``MAX_DEPTH``, about once in 10**4. Nothing is collected but the names of large nodes, whose number is
bounded by ``MAX_SHARE``: links, labels and pairs stay tables in the shared folder, and go when they are superseded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.llm.common import LOWER, Scratch, WordHashes, bounded, byte_texts, mixed, partitions, sliced

TOKENS, SKETCH, TREES, START, MAX_DEPTH, DEEPER = 64, 32, 4, 3, 6, 3
#: Sketch bytes that must agree. At similarity 0.8 fewer agree in 1 of 100,000 pairs; at 0.3 so many do in one of 40.
AGREE = 15
#: Pairs of which so many bytes agree are surely alike: at similarity 0.8 one in 30 does so.
SURE = 30
#: A node with more likely pairs than this for each of its classes is not spelt out in pairs.
PARTNERS = 4
#: A node of more than this share of all classes counts as large; so there are at most this many for each level and path.
MAX_SHARE = 1 << 16
#: How many shingles of a mixed node meet in a block.
BLOCK = 1 << 20
_SKETCH = [f"sketch_{k}" for k in range(SKETCH // 8)]

_ROWS = "node long, block int, id long, n int, label long, " + ", ".join(f"{c} long" for c in _SKETCH)


def _multipliers(count: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_MULTIPLIERS = _multipliers(TOKENS + SKETCH)


def shingle_set(text: bytes, hash_words: WordHashes, shingle: int) -> np.ndarray:
    """Ascending hashes of the distinct shingles; of all words together if there are fewer."""
    words = hash_words(text.translate(LOWER).split())
    if not len(words):
        return words
    size = min(shingle, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(out)])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(TOKENS + SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 2048):
        np.minimum(low, (hashes[k : k + 2048, None] * _MULTIPLIERS).min(axis=0), out=low)
    return low


def _parts(docs: DataFrame, shingle: int) -> DataFrame:
    """Of each document its key, its text's hash, the class, and the size, tokens and sketch of its set."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = WordHashes()
        for b in sliced(batches, 2):
            n, prints, tokens, sketches = [], [], [], []
            for text in byte_texts(b.column(2)):
                hashes = shingle_set(text, hash_words, shingle)
                low = signature(hashes)
                n.append(len(hashes))
                prints.append(xxhash.xxh3_64_intdigest(hashes.tobytes()))
                tokens.append((low[:TOKENS] >> np.uint64(48)).astype(np.uint16).tobytes())
                sketches.append((low[TOKENS:] >> np.uint64(24)).astype(np.uint8))
            both = np.array(sketches, np.uint8).reshape(-1, SKETCH).view(np.int64)
            ids = pa.array(np.array(prints, np.uint64).view(np.int64))
            columns = [b.column(0), b.column(1), ids, pa.array(n, pa.int32()), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.ascontiguousarray(x)) for x in both.T)], names=["key", "hash", "id", "n", "tokens", *_SKETCH])

    schema = f"key {docs.schema['key'].dataType.simpleString()}, hash long, id long, n int, tokens binary, " + ", ".join(f"{c} long" for c in _SKETCH)
    return docs.select("key", "hash", "text").mapInArrow(run, schema)


def _children(nodes: np.ndarray, entry: np.ndarray, tokens: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes that the classes ``entry`` (rows of ``tokens``) are in, and which class is in each.

    Near the root a node chooses two tokens; below, one, and every fourth node a second one (1 / 0.8 on average).
    """
    width = tokens.shape[1]
    one = mixed(nodes ^ np.uint64(0xA5A5A5A5)) % np.uint64(width)
    two = (one + np.uint64(1) + mixed(nodes ^ np.uint64(0x5A5A5A5A)) % np.uint64(width - 1)) % np.uint64(width)
    second = np.ones(len(nodes), bool) if both else mixed(nodes ^ np.uint64(0xC3C3C3C3)) % np.uint64(4) == 0
    at = np.concatenate((np.arange(len(nodes)), np.flatnonzero(second)))
    coordinate = np.concatenate((one, two[second]))
    value = tokens[entry[at], coordinate.astype(np.int64)].astype(np.uint64)
    return mixed(mixed(nodes[at] + coordinate + np.uint64(1)) ^ value), entry[at]


class Descent:
    """The way of classes down some trees. ``large``: by level from ``START`` on, the ascending large nodes and their sizes."""

    def __init__(self, trees: range, node_limit: int, large: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.trees, self.node_limit, self.large = trees, node_limit, large

    def __call__(self, tokens: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
        """(nodes, classes) at which classes stop before the last level that is known, and those at that level."""
        nodes = np.repeat(mixed(np.array(self.trees, np.uint64) + np.uint64(1)), len(tokens))
        entry = np.tile(np.arange(len(tokens)), len(self.trees))
        for _ in range(START):
            nodes, entry = _children(nodes, entry, tokens, True)
        stops = []
        for level, (names, _) in enumerate(self.large):
            k = np.minimum(np.searchsorted(names, nodes), len(names) - 1)
            inside = names[k] == nodes
            stops.append((nodes[~inside], entry[~inside]))
            nodes, entry = nodes[inside], entry[inside]
            if START + level < MAX_DEPTH:
                nodes, entry = _children(nodes, entry, tokens, False)
        return stops, (nodes, entry)

    def blocks(self, nodes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The block, from 1 on, of each class in a node that is large at ``MAX_DEPTH``; 0 elsewhere."""
        if START + len(self.large) <= MAX_DEPTH:
            return np.zeros(len(nodes), np.int32)
        names, sizes = self.large[-1]
        count = np.maximum(1, sizes[np.searchsorted(names, nodes)] // self.node_limit).astype(np.uint64)
        return (mixed(nodes ^ mixed(ids)) % count).astype(np.int32) + 1


def _token_matrix(b: pa.RecordBatch) -> np.ndarray:
    column = b.column(b.schema.get_field_index("tokens"))
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TOKENS)


def _large_nodes(classes: DataFrame, trees: range, node_limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The large nodes of each level with their sizes, estimated from a sample of the classes.

    The sample decides how far classes branch, and so how work is spread; no link depends on it.
    """
    rate = max(1, min(32, node_limit // 8))
    least = max(node_limit, classes.count() / MAX_SHARE) / rate
    sample = classes.filter(F.pmod("id", F.lit(rate)) == 0).select("tokens")
    large: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(START, MAX_DEPTH + 1):
        down = Descent(trees, node_limit, list(large))

        def run(batches, down=down):
            for b in batches:
                nodes, n = np.unique(down(_token_matrix(b))[1][0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(n)], names=["node", "n"])

        found = sample.mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).filter(F.col("n") > least).toArrow()
        if not found.num_rows:
            break
        names, sizes = found["node"].to_numpy().view(np.uint64), found["n"].to_numpy() * rate
        order = np.argsort(names)
        large.append((names[order], sizes[order]))
    return large


def _rows(classes: DataFrame, down: Descent, spark: SparkSession) -> DataFrame:
    """A row for each class (id, n, label, tokens, sketch) and each node that it stops at."""
    shared = spark.sparkContext.broadcast(down)

    def run(batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("id")).to_numpy().view(np.uint64)
            stops, last = shared.value(_token_matrix(b))
            nodes, entry = (np.concatenate(x) for x in zip(*stops, last, strict=True))
            block = np.zeros(len(nodes), np.int32)
            block[len(nodes) - len(last[0]) :] = shared.value.blocks(last[0], ids[last[1]])
            take = pa.array(entry)
            columns = [b.column(b.schema.get_field_index(c)).take(take) for c in ("id", "n", "label", *_SKETCH)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(block), *columns], names=["node", "block", "id", "n", "label", *_SKETCH])

    return classes.select("id", "n", "label", "tokens", *_SKETCH).mapInArrow(run, _ROWS)


def _agreeing(a: dict[str, np.ndarray], i: np.ndarray, b: dict[str, np.ndarray], j: np.ndarray, percent: int, agree: int) -> np.ndarray:
    """For pairs (a[i], b[j]) of different labels one more than the number of equal sketch bytes, or 0 if they can't (by set sizes) or hardly can be linked."""
    x, y = a["n"][i].astype(np.int64), b["n"][j].astype(np.int64)
    out = np.zeros(len(i), np.int64)
    ok = np.flatnonzero((100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & (a["label"][i] != b["label"][j]))
    out[ok] = (a["sketch"][i[ok]] == b["sketch"][j[ok]]).sum(axis=1) + 1
    out[out <= agree] = 0
    return out


def _columns(b: pa.RecordBatch, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    get = lambda c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
    out = {c: get(c) for c in names}
    out["sketch"] = np.stack([get(c) for c in _SKETCH], axis=1).view(np.uint8).reshape(-1, SKETCH)
    return out


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _nodes_in(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Whole nodes (or blocks of them) from rows that are sorted by node and block; one that a batch's end cuts is carried over."""
    names = ("node", "block", "id", "n", "label")
    rest: list[dict[str, np.ndarray]] = []
    for b in batches:
        if not b.num_rows:
            continue
        r = _columns(b, names)
        if rest and (r["node"][0], r["block"][0]) == (rest[0]["node"][0], rest[0]["block"][0]) == (r["node"][-1], r["block"][-1]):
            rest.append(r)
            continue
        r = {c: np.concatenate([*(x[c] for x in rest), r[c]]) for c in r}
        last = int(np.flatnonzero((r["node"] == r["node"][-1]) & (r["block"] == r["block"][-1]))[0])
        rest = [{c: x[last:] for c, x in r.items()}]
        if last:
            yield {c: x[:last] for c, x in r.items()}
    if rest:
        yield {c: np.concatenate([x[c] for x in rest]) for c in rest[0]}


def _refined(r: dict[str, np.ndarray], limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(small node, row, is it one of several blocks) for the rows' nodes, of which large ones branch on by sketch bytes."""
    node = mixed(r["node"].view(np.uint64) ^ mixed(r["block"].astype(np.uint64)))
    index = np.arange(len(node))
    for _ in range(DEEPER):
        _, place, size = np.unique(node, return_inverse=True, return_counts=True)
        big = size[place] > limit
        if not big.any():
            break
        kids, rows = _children(node[big], index[big], r["sketch"], False)
        node, index = np.concatenate((node[~big], kids)), np.concatenate((index[~big], rows))
    order = np.lexsort((index, node))
    node, index = node[order], index[order]
    first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    size = np.diff(np.append(first, len(node)))
    nth = np.arange(len(node)) - np.repeat(first, size)
    cut = np.repeat(size, size) > limit
    return node + (nth // limit).astype(np.uint64), index, cut


def _likely(r: dict[str, np.ndarray], node: np.ndarray, index: np.ndarray, percent: int, agree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (i, j) of likely pairs in each small node, and how many bytes agree."""
    found, step = [], 1
    while step < len(node):
        i = np.flatnonzero(node[step:] == node[:-step])
        if not len(i):
            break
        equal = _agreeing(r, index[i], r, index[i + step], percent, agree)
        found.append((i[equal > 0], i[equal > 0] + step, equal[equal > 0] - 1))
        step += 1
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _partners(rows: DataFrame, percent: int, node_limit: int, agree: int) -> DataFrame:
    """(a, b): of each class b the smallest partner among the sure ones, and the most alike one, of all of its nodes."""

    def run(batches):
        for r in _nodes_in(batches):
            node, index, _ = _refined(r, node_limit)
            i, j, equal = _likely(r, node, index, percent, agree)
            x, y = r["id"][index[i]], r["id"][index[j]]
            a, b = np.minimum(x, y), np.maximum(x, y)
            picked = []
            for order in (np.lexsort((a, equal < SURE, b)), np.lexsort((a, -equal, b))):
                picked.append(order[np.concatenate(([True], b[order][1:] != b[order][:-1]))] if len(order) else order)
            take = np.unique(np.concatenate(picked))
            yield pa.RecordBatch.from_arrays([pa.array(a[take]), pa.array(b[take]), pa.array(equal[take])], names=["a", "b", "equal"])

    found = _dealt(rows).mapInArrow(run, "a long, b long, equal long")
    both = found.groupBy("b").agg(F.min(F.struct(F.col("equal") < SURE, "a"))["a"].alias("first"), F.min(F.struct(-F.col("equal"), F.col("a")))["a"].alias("best"))
    return both.select(F.explode(F.array_distinct(F.array("first", "best"))).alias("a"), "b")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), "node", "block").sortWithinPartitions("node", "block")


def _stated(rows: DataFrame, percent: int, node_limit: int, agree: int) -> DataFrame:
    """Likely pairs (a, b) of different labels; or (node, label) for the labels of nodes that are not spelt out in pairs."""

    def run(batches):
        for r in _nodes_in(batches):
            node, index, cut = _refined(r, node_limit)
            i, j, _ = _likely(r, node, index, percent, agree)
            _, place, size = np.unique(node, return_inverse=True, return_counts=True)
            dense = np.bincount(place[i], minlength=len(size)) > PARTNERS * size
            few = ~dense[place[i]]
            a, b = r["id"][index[i[few]]], r["id"][index[j[few]]]
            pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            named = index[dense[place] | cut | (r["block"][index] > 0)]
            labels = np.unique(np.stack((r["node"][named], r["label"][named]), axis=1), axis=0)
            none, gap = pa.nulls(len(pairs), pa.int64()), pa.nulls(len(labels), pa.int64())
            columns = [pa.concat_arrays(x) for x in ([pa.array(pairs[:, 0]), gap], [pa.array(pairs[:, 1]), gap], [none, pa.array(labels[:, 0])], [none, pa.array(labels[:, 1])])]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "node", "label"])

    return _dealt(rows).mapInArrow(run, "a long, b long, node long, label long")


def _with_sets(docs: DataFrame, classes: DataFrame, need: DataFrame, shingle: int) -> DataFrame:
    """``need`` (id and longs) with the full set of each id, from one document of the class.

    ``docs`` has one row for each key and hash. A text moves once, to meet its needed rows; it goes to Python with each.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = need.columns
    schema = f"{', '.join(f'{c} {t}' for c, t in need.dtypes)}, members binary"
    arrow = to_arrow_schema(need.schema)

    def run(batches):
        hash_words, last, data = WordHashes(), None, b""
        for b in sliced(batches, 0):
            sets = []
            for text in byte_texts(b.column(0)):
                if text != last:  # a document's rows stand together
                    last, data = text, shingle_set(text, hash_words, shingle).tobytes()
                sets.append(data)
            columns = [b.column(b.schema.get_field_index(c)).cast(arrow.field(c).type) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], names=[*names, "members"])

    of = need.join(classes.select("id", F.col("key").alias("__key"), F.col("hash").alias("__hash")), "id")
    return docs.join(of, (F.col("hash") == F.col("__hash")) & F.col("key").eqNullSafe(F.col("__key"))).select("text", *names).mapInArrow(run, schema)


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, percent: int, share: int = 256) -> DataFrame:
    """The pairs whose full sets reach the similarity. A hub's partners are dealt over as many tasks as their number asks for."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / share).cast("int").alias("parts"))
    hubs = parts.select(F.col("a").alias("id"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("place"))
    others = pairs.join(parts, "a").select(F.col("b").alias("id"), F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("place"))

    def run(batches):
        hub, members = None, None
        for b in batches:
            a_s, b_s = [], []
            for i, h, part, place, data in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("id", "hub", "part", "place", "members")), strict=True):
                mine = np.frombuffer(data, np.uint64)
                if place == 0:
                    hub, members = (h, part), mine
                elif hub == (h, part):
                    common = len(members) + len(mine) - len(np.union1d(members, mine))
                    if 100 * common >= percent * (len(members) + len(mine) - common):
                        a_s.append(h)
                        b_s.append(i)
            yield _pair_batch(np.array(a_s, np.int64), np.array(b_s, np.int64))

    found = _with_sets(docs, classes, hubs.unionByName(others), shingle)
    n = partitions(pairs.sparkSession)
    return found.repartition(n, "hub", "part").sortWithinPartitions("hub", "part", "place").mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, label): the smallest id reachable by links, for every id that has one.

    Every vertex moves to its smallest neighbour, and on to where that one moves, until all stand on roots; then links
    between roots are what is left. Each round halves the roots at least, and moves double their reach each time, so a
    chain of n links takes about log2(n) tables. What is superseded is deleted.
    """
    scratch = scratch or Scratch(links.sparkSession, "components")
    edges, labels = scratch.write(links.filter("a <> b").select("a", "b").distinct()), None
    while True:
        ends = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionAll(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        move, before = ends.groupBy("v").agg(F.least("v", F.min("u")).alias("to")), None
        while True:
            on = move.filter("v <> to").select(F.col("v").alias("to"), F.col("to").alias("on"))
            further = scratch.write(move.join(on, "to", "left").select("v", F.coalesce("on", "to").alias("to"), F.col("on").isNotNull().alias("moved")))
            scratch.drop(before)
            move, before = further.select("v", "to"), further
            if further.filter("moved").isEmpty():
                break
        old = labels
        if labels is None:
            labels = scratch.write(move.select(F.col("v").alias("id"), F.col("to").alias("label")))
        else:
            labels = scratch.write(labels.join(move.withColumnRenamed("v", "label"), "label", "left").select("id", F.coalesce("to", "label").alias("label")))
        moved = edges.join(move.select(F.col("v").alias("a"), F.col("to").alias("x")), "a").join(move.select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
        left = scratch.write(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        scratch.drop(old, edges, further)
        edges = left
        if edges.isEmpty():
            scratch.drop(edges)
            return labels


def _united(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The labels after further links: only the components that these join move."""
    ends = _labelled(_labelled(links.select(F.col("a").alias("id"), "b"), labels).select(F.col("label").alias("a"), F.col("b").alias("id")), labels)
    joined = components(ends.select("a", F.col("label").alias("b")), scratch)
    # The ends of a link may have had no label before.
    known = labels.unionAll(joined.select("id", F.col("id").alias("label")).join(labels.select("id"), "id", "left_anti"))
    moved = scratch.write(known.join(joined.select(F.col("id").alias("label"), F.col("label").alias("to")), "label", "left").select("id", F.coalesce("to", "label").alias("label")))
    scratch.drop(labels, joined)
    return moved


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    found = labels.select(F.col("id"), F.col("label").alias("__found"))
    return rows.drop("label").join(found, "id", "left").withColumn("label", F.coalesce("__found", "id")).drop("__found")


def _rest_links(docs: DataFrame, classes: DataFrame, rows: DataFrame, shingle: int, percent: int, agree: int) -> DataFrame:
    """Links between different labels in the nodes of ``rows`` (node, id, n, label, sketch), enough to join the labels that they join.

    A node's classes are dealt into blocks of ``BLOCK`` shingles; those outside its commonest label visit all of them,
    once for each block, and are compared on full sets. Of two visitors the smaller one is compared with the other.
    """
    counts = rows.groupBy("node", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    nodes = counts.groupBy("node").agg(F.max_by("label", F.struct("rows", "label")).alias("common"), F.sum("shingles").alias("size"), F.count("*").alias("kinds")).filter("kinds > 1")
    there = rows.join(nodes.select("node", "common", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "node")
    own = F.array(F.struct(F.lit(0).alias("visit"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.lit(1).alias("visit"), k.alias("block")))
    places = F.when(F.col("label") == F.col("common"), own).otherwise(F.concat(own, others))
    need = there.select("node", "id", "n", "label", "common", *_SKETCH, F.explode(places).alias("place")).select("*", "place.*").drop("place")

    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        sets: list[bytes] = []
        whole, flat, begin = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            r = _columns(b, ("node", "block", "visit", "id", "n", "label", "common"))
            members = b.column(b.schema.get_field_index("members")).to_pylist()
            edges = np.flatnonzero((np.diff(r["node"]) != 0) | (np.diff(r["block"]) != 0) | (np.diff(r["visit"]) != 0)) + 1
            for x in np.split(np.arange(b.num_rows), edges):
                if not len(x):
                    continue
                part, its = {c: v[x] for c, v in r.items()}, members[x[0] : x[-1] + 1]
                same = bool(held) and (held[0]["node"][0], held[0]["block"][0]) == (part["node"][0], part["block"][0])
                if part["visit"][0] == 0:
                    held, sets, whole = ([*held, part], [*sets, *its], None) if same else ([part], its, None)
                elif same:
                    if whole is None:
                        whole = {c: np.concatenate([h[c] for h in held]) for c in part}
                        flat = np.frombuffer(b"".join(sets), np.uint64)
                        begin = np.cumsum(whole["n"]) - whole["n"]
                    for k in range(len(x)):
                        likely = (whole["label"] == whole["common"]) | (whole["id"] > part["id"][k])
                        j = np.flatnonzero(likely)
                        j = j[_agreeing(part, np.full(len(j), k), whole, j, percent, agree) > 0]
                        mine = np.frombuffer(its[k], np.uint64)
                        hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat if len(j) else flat
                        common = np.add.reduceat(hit, begin, dtype=np.int64)[j] if len(j) else j
                        j = j[100 * common >= percent * (len(mine) + whole["n"][j].astype(np.int64) - common)]
                        # One link to a label is enough.
                        j = j[np.unique(whole["label"][j], return_index=True)[1]]
                        if len(j):
                            yield _pair_batch(np.full(len(j), part["id"][k]), whole["id"][j])

    n = partitions(rows.sparkSession)
    found = _with_sets(docs, classes, need, shingle)
    return found.repartition(n, "node", "block").sortWithinPartitions("node", "block", "visit").mapInArrow(run, "a long, b long").distinct()


def near_dup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 5, percent: int = 80, node_limit: int = 256, agree: int = AGREE) -> DataFrame:
    """One row per document: the id, n_shingles, component_id (the smallest id reachable by links), kept.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. A document's set has its distinct shingles of
    ``shingle`` words; with fewer words, all of them as one. Null, empty and blank texts have no set and link with
    nothing. Links: 100 * intersection >= percent * union. Ids may be of any type that can be ordered. Rows that share an
    id are one document, so all of their texts are in one component; but null ids are documents of their own, which
    count as smaller than any other; component_id is then null. kept: the id is the component's. Shingles are 64-bit
    hashes, and so are the names of classes. ``agree=0`` compares all classes of a node on full sets, without sketches.
    """
    spark = docs.sparkSession
    bounded(spark)
    scratch = Scratch(spark, "near-dup")
    keyed = docs.select(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    parts = scratch.write(_parts(keyed, shingle))
    one = F.min(F.struct(F.col("key").isNotNull().alias("real"), "key", "hash")).alias("one")
    firsts = (F.first(c).alias(c) for c in ("n", "tokens", *_SKETCH))
    grouped = parts.filter("n > 0").groupBy("id").agg(one, *firsts)
    # Rows that repeat an id and its text would all meet what is needed of their class.
    repeated = parts.groupBy("key", "hash").agg(F.count("*").alias("rows")).filter("rows > 1")
    texts = keyed if repeated.isEmpty() else scratch.write(keyed.dropDuplicates(["key", "hash"]))
    classes = scratch.write(grouped.select("id", "one.key", "one.hash", "n", "tokens", *_SKETCH, F.col("id").alias("label")))

    large = _large_nodes(classes, range(1 + TREES), node_limit)
    descent = lambda trees: Descent(trees, node_limit, large)
    pairs = scratch.write(_partners(_rows(classes, descent(range(1)), spark), percent, node_limit, agree))
    links = scratch.write(_confirmed(texts, classes, pairs, shingle, percent))
    # An id that stands for several classes ties them together.
    several = parts.filter("n > 0 AND key IS NOT NULL").groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a <> b")
    tied = parts.filter("n > 0").join(several.select("key", "a"), "key").select("a", F.col("id").alias("b")).filter("a <> b").distinct()
    links = links.unionAll(scratch.write(tied))
    labels = components(links, scratch)
    scratch.drop(pairs)

    found = scratch.write(_stated(_rows(_labelled(classes, labels), descent(range(1, 1 + TREES)), spark), percent, node_limit, agree))
    pairs = scratch.write(found.filter("b IS NOT NULL").select("a", "b").distinct())
    more = [] if pairs.isEmpty() else [scratch.write(_confirmed(texts, classes, pairs, shingle, percent))]
    mixed_nodes = scratch.write(found.filter("node IS NOT NULL").groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("node"))
    if more:
        labels = _united(labels, more[0], scratch)
    if not mixed_nodes.isEmpty():
        rows = scratch.write(_rows(_labelled(classes, labels), descent(range(1, 1 + TREES)), spark).drop("block").join(mixed_nodes, "node", "left_semi"))
        more.append(scratch.write(_rest_links(texts, classes, rows, shingle, percent, agree)))
        scratch.drop(rows)
        if not more[-1].isEmpty():
            labels = _united(labels, more[-1], scratch)

    real = F.struct(F.col("key").isNotNull().alias("real"), "key")
    full = _labelled(parts.filter("n > 0").select("key", "n", "id"), labels)
    least = full.groupBy("label").agg(F.min(real)["key"].alias("least"))
    of = full.join(least, "label").select("key", "n", "least").unionAll(parts.filter("n = 0").select("key", "n", F.col("key").alias("least")))
    out = of.select(F.col("key").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"), F.col("key").eqNullSafe(F.col("least")).alias("kept"))
    done = scratch.write(out)
    scratch.drop(parts, classes, labels, found, pairs, mixed_nodes, texts, *more)
    return done
