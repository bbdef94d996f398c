"""Every operator against its plain-Python version: on hand-made rows with all the odd cases, and on a small table."""

import random
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import brute  # noqa: E402

from marketlane.llm import chat, decontaminate, line_dedup, near_dup, quality_classifier, quality_rules, sentencepiece_codec, substring_dedup, url_filter, warc  # noqa: E402

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, n_words string, spans string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


def made_texts():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(60)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, passage = say(300), say(40)
    lines = "\n".join(say(6) for _ in range(8))
    near = base.split()
    near[150] = "other"
    texts = [None, "", " \n\t ", "one", "TWO words", base, base, base.upper(), " ".join(near), passage, say(30) + " " + passage, passage + " " + passage, lines, say(5) + "\n" + lines + "\n" + lines, "\n\n\n\n\n", "x " * 3000, "same " * 20, "same " * 39, say(20000), "no-break\u00a0space \x0b\x0c\r\n#*$%&|<> 🎉 ▁ ▁▁"]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, t, "en", "clash", "clash") for i, t in enumerate(made_texts())]
    return spark.createDataFrame(data, DOC).repartition(5)


@pytest.fixture(scope="module")
def pairs():
    return list(enumerate(made_texts()))


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def plain(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


BENCH = [(1, None), (2, ""), (3, "one"), (4, "Two, words!"), (None, "same same same same same same same same same same same"), (10, None), (11, "x x x x x x x x x x x x")]


@pytest.mark.parametrize("block,shard", [(200_000, 1 << 17), (2, 50)])
def test_decontaminate(spark, docs, pairs, block, shard):
    bench = BENCH + [(20, " ".join(made_texts()[9].split()[:12])), (20, " ".join(made_texts()[9].split()[:12])), (21, made_texts()[9])]
    b = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.decontaminate(docs, b, block_windows=block, longest_shard=shard)
    same(rows(decontaminate.digest(found), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"), brute.op1(pairs, bench))
    clean = {r.doc_id: r.text for r in decontaminate.remove_spans(found).collect()}
    hit = {r[0] for r in brute.op1(pairs, bench) if r[5]}
    assert all(clean[i] == t for i, t in pairs if i not in hit)
    assert {r.doc_id: r.text for r in decontaminate.decontaminate(docs, b, block_windows=block, cut=True).collect()} == clean
    again = decontaminate.decontaminate(spark.createDataFrame([(i, clean[i]) for i in hit], "doc_id long, text string"), b)
    assert again.selectExpr("sum(n_words)").first()[0] == sum(r[1] - r[2] for r in brute.op1(pairs, bench) if r[0] in hit)


def test_decontaminate_empty(spark, docs, pairs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.decontaminate(docs, none)).filter("contaminated").isEmpty()
    assert decontaminate.decontaminate(docs.limit(0), none).count() == 0


def test_fm_index():
    import numpy as np

    r = random.Random(3)
    text = np.array([r.choice([1, 2, 3]) for _ in range(400)] + [0] + [r.choice([1, 2]) for _ in range(90)] + [0])
    index = decontaminate.FMIndex(text, 4)
    for n in (1, 2, 5, 9):
        want = {}
        for k in range(len(text) - n + 1):
            if (text[k : k + n] > 0).all():
                want.setdefault(tuple(text[k : k + n].tolist()), []).append(k)
        low, high = index.search(np.array(list(want)))
        assert [sorted(index.locate(np.arange(a, b)).tolist()) for a, b in zip(low, high, strict=True)] == list(want.values())


def test_substring_dedup(spark, docs, pairs):
    want = brute.op2(pairs)
    same(rows(substring_dedup.digest(docs), "doc_id", "n_words", "n_removed", "kept_sha256"), want)
    whole = substring_dedup.substring_dedup(docs).select("doc_id", F.expr("aggregate(spans, 0, (a, s) -> a + s.end - s.start)").alias("gone"))
    same(rows(whole, "doc_id", "gone"), [(r[0], r[2]) for r in want])
    assert substring_dedup.digest(docs.limit(0)).count() == 0


def test_substring_dedup_odd_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    data = [(None, text), (None, text), (7, text), (7, text), (7, "short")]
    got = substring_dedup.digest(spark.createDataFrame(data, "doc_id long, text string"))
    assert sorted(got.select("n_removed").toPandas()["n_removed"]) == [0, 0, 30, 30, 30]
    assert got.filter("doc_id IS NULL AND n_removed = 0").count() == 1


def test_line_dedup(spark, docs, pairs):
    found = line_dedup.line_dedup(docs)
    same(rows(line_dedup.digest(found), "doc_id", "n_lines", "n_removed_lines", "kept_sha256"), brute.op5(pairs))
    assert found.filter("text IS NULL").count() == 1
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0
    small = plain(table(spark, "documents"), "doc_id", "text")
    same(rows(line_dedup.digest(line_dedup.line_dedup(table(spark, "documents"))), "doc_id", "n_lines", "n_removed_lines", "kept_sha256"), brute.op5(small))


def test_line_dedup_repeated_rows(spark):
    data = [(None, "a\nb\nc\nd"), (3, "a\nb\nc"), (3, "a\nb\nc"), (3, "x")]
    got = line_dedup.line_dedup(spark.createDataFrame(data, "doc_id long, text string"))
    assert rows(got, "doc_id", "text", "n_removed_lines") == sorted([(None, "a\nb\nc\nd", 0), (3, "", 3), (3, "", 3), (3, "x", 0)], key=repr)


def test_near_dup(spark, docs, pairs):
    for shingle in (2, 5):
        found = near_dup.near_dup(docs, shingle=shingle)
        same(rows(found, "doc_id", "n_shingles", "component_id", "kept"), brute.op7(pairs, shingle))
    assert near_dup.near_dup(docs.limit(0)).count() == 0


def test_near_dup_large_nodes(spark):
    """A group of near copies beyond the node limit, a chain that only confirmed links join, and unlike texts."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(60):
        t = list(base)
        for k in r.sample(range(120), r.randint(1, 6)):
            t[k] = word()
        texts.append(" ".join(t))
    chain = [word() for _ in range(120)]
    for _ in range(25):
        chain[r.randrange(120)] = word()
        texts.append(" ".join(chain))
    texts += [" ".join(word() for _ in range(100)) for _ in range(60)]
    r.shuffle(texts)
    data = list(enumerate(texts))
    df = spark.createDataFrame(data, "doc_id long, text string")
    for limit in (4, 128):
        same(rows(near_dup.near_dup(df, shingle=2, node_limit=limit), "doc_id", "n_shingles", "component_id", "kept"), brute.op7(data))


def test_near_dup_odd_ids(spark):
    """Rows that share an id are in one component, whatever their texts; null ids are documents of their own; any type of id will do."""
    df = spark.createDataFrame([(None, "a b c d"), (None, "q r s"), (4, "a b c d"), (4, "a b c d"), (5, "other"), (5, "")], "doc_id long, text string")
    got = rows(near_dup.near_dup(df), "doc_id", "component_id", "kept")
    assert got == sorted([(None, None, True), (None, None, True), (4, None, False), (4, None, False), (5, 5, True), (5, 5, True)], key=repr)
    tied = [(1, "one text here"), (4, "one text here"), (4, "and quite another"), (5, "and quite another"), (9, "alone")]
    want = [(1, 1, True), (4, 1, False), (4, 1, False), (5, 1, False), (9, 9, True)]
    for kind in ("long", "string"):
        df = spark.createDataFrame(tied, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
        got = near_dup.near_dup(df, shingle=2).select(*(F.col(c).cast("long") for c in ("doc_id", "component_id")), "kept")
        assert rows(got, "doc_id", "component_id", "kept") == sorted(want, key=repr)


def test_near_dup_of_alike_texts_that_are_no_pairs(spark):
    """A group in which all pairs look alike, but few are: nodes of many labels are compared to the end."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base, texts = [word() for _ in range(150)], []
    for _ in range(90):
        t = list(base)
        for k in r.sample(range(150), r.randint(5, 14)):
            t[k] = word()
        texts.append(" ".join(t))
    data = list(enumerate(texts))
    df = spark.createDataFrame(data, "doc_id long, text string")
    for limit, agree in ((4, near_dup.AGREE), (8, 0), (256, near_dup.AGREE)):
        same(rows(near_dup.near_dup(df, shingle=2, node_limit=limit, agree=agree), "doc_id", "n_shingles", "component_id", "kept"), brute.op7(data))


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200)]
    got = dict(near_dup.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}


def test_components_of_a_long_chain_take_few_tables(spark):
    from marketlane.llm.common import Scratch

    scratch = Scratch(spark, "chain")
    links = spark.range(1, 1000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = near_dup.components(links, scratch)
    assert got.count() == 1000 and got.filter("label <> 1").isEmpty()
    assert scratch.count < 20


def test_quality_rules(spark, docs, pairs):
    found = quality_rules.quality_rules(docs)
    same(rows(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), brute.op10(pairs))
    assert found.filter("kept AND base_failed").isEmpty() and quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_quality_rules_verdict(spark, docs, pairs):
    """The method's verdict against shares spelt out with plain Python."""
    small = plain(table(spark, "documents"), "doc_id", "text")
    for data, df in ((pairs, docs), (small, table(spark, "documents"))):
        want = []
        for (i, text), base in zip(data, brute.op10(data), strict=True):
            text, bad = text or "", base[6]
            w = brute.spaced(text)
            chars = max(1, sum(map(len, w)))
            for n, most in ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10)):
                at = {}
                for k in range(len(w) - n + 1):
                    at.setdefault(tuple(w[k : k + n]), []).append(k)
                inside = {x for v in at.values() if len(v) > 1 for k in v for x in range(k, k + n)}
                bad |= sum(len(w[x]) for x in inside) / chars > most
            seen, again = set(), 0
            for line in text.split("\n"):
                again += sum(map(len, brute.spaced(line))) if line in seen else 0
                seen.add(line)
            want.append((i, not (bad or again / chars > 0.2)))
        same(rows(quality_rules.quality_rules(df), "doc_id", "kept"), want)
    assert {k for _, k in want} == {True, False}
    twice = spark.createDataFrame([(1, "a b " * 30), (1, "a b " * 30)], "doc_id long, text string")
    assert rows(quality_rules.quality_rules(twice), "doc_id", "kept") == [(1, False)] * 2


@pytest.mark.parametrize("name", ["op4_warc", "op8_url_filter", "op10_quality_rules"])
def test_queries_against_sql(spark, name):
    import duckdb

    from marketlane.llm import queries

    duck = duckdb.connect()
    for t in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = duck.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(got.columns)
    same(rows(got, *found.columns), found.fetchall())


def test_quality_rules_coverage(spark):
    """Shares of characters inside duplicated n-grams, against words spelt out."""
    for text in made_texts():
        w = brute.spaced(text)
        row = quality_rules.judged((text or "").encode(), quality_rules.WordHashes(), quality_rules.Rolling())
        for n, share in row[6]:
            at = {}
            for k in range(len(w) - n + 1):
                at.setdefault(tuple(w[k : k + n]), []).append(k)
            inside = {i for v in at.values() if len(v) > 1 for k in v for i in range(k, k + n)}
            assert share == pytest.approx(sum(len(w[i]) for i in inside) / max(1, sum(map(len, w))))


URLS = [None, "", "no scheme", "http://", "http://COM", "http://com/", "https://Www.Example.com/en/x", "https://a.www.example.com/en/", "https://blog.example.com/en/?q", "https://example.com/EN/", "http://xexample.com/en/", "http://h.net/es/a#b", "http://h.net/es", "http://h.net/a?/es/", "ftp://u@h.net:80/fr/", "http://h.net#/fr/", "http://evil.org/.example.com/en/", "x://" + "a." * 200 + "com/" + "p" * 3000, "http://é.net/fr/ü", "a\nb://h.net/fr/\n"]


def test_url_filter(spark):
    data = list(enumerate(URLS)) + [(0, "http://a.com/")]
    df = spark.createDataFrame(data, "page_id long, url string").withColumn("host", F.lit(1))
    same(rows(url_filter.url_filter(df, method=()), "page_id", "host", "path", "rule", "verdict"), brute.op8(data))
    assert url_filter.url_filter(df.limit(0)).count() == 0


def test_url_filter_decides_what_the_rules_leave_open(spark):
    """The method's globs, which take many words of bits, against patterns tried one by one."""
    import re

    urls = ["http://ads.site.org/x", "http://cdn.pixel-7.site.io/", "http://a.org/shop/cart/7", "http://a.org/cart", "http://a.org/cart/", "http://a.org/x/login.php", "http://a.org/x;psession=3", "http://a.com/cart/", "http://badsite.org/", "http://a.org/x/loginphp"] + [u for u in URLS if u]
    urls += [u for (u,) in plain(table(spark, "pages"), "url") if u]
    data = list(enumerate(urls))
    got = url_filter.url_filter(spark.createDataFrame(data, "page_id long, url string"))
    star = lambda s: "[^\n]*".join(map(re.escape, s.split("*")))
    ranked = [url_filter.METHOD[i] for i in url_filter.ranking(url_filter.METHOD)]
    patterns = [(re.compile(rf"(?:[^\n]*\.)?{star(g.host)}\n{star(g.path)}[^\n]*"), g.name) for g in ranked]
    assert url_filter.ShiftAnd([g.symbols() for g in url_filter.METHOD]).words > 10
    want = []
    for i, host, path, rule, verdict in brute.op8(data):
        glob = next((n for p, n in patterns if p.fullmatch(f"{host}\n{path}".replace("\r", ""))), None) if rule is None and "\n" not in host + path else None
        want.append((i, rule, "block" if glob else verdict, glob))
    assert sum(bool(w[3]) for w in want) >= 6
    same(rows(got, "page_id", "rule", "verdict", "glob"), want)


def test_url_filter_on_hosts_that_only_begin_alike(spark):
    """Hosts whose names begin or end like a word of the list are no advertisers; those with the word as a part of a label are."""
    good = "countertop-shop.com adsorption-lab.org statsbomb.io clickhouse.org trackandfield.org pixelart-museum.org metricsystem.edu bannerman.org my-beads.example.org ads.org track-shop.org"
    bad = "ads.example.org eu-ads.example.org tracker-7.example.org a.b.metrics.example.org"
    pages = [(h, f"https://{h}/") for h in f"{good} {bad}".split()]
    got = {r.page_id: r.verdict for r in url_filter.url_filter(spark.createDataFrame(pages, "page_id string, url string")).collect()}
    assert {h for h, v in got.items() if v == "block"} == set(bad.split())


def test_globs_with_inner_stars():
    import re

    import numpy as np

    r = random.Random(2)
    rules = [url_filter.Rule("".join(r.choice("ab.*") for _ in range(r.randint(1, 9))).strip("*") or "a", "/" + "".join(r.choice("xy/*") for _ in range(r.randint(0, 30))).rstrip("*"), "block") for _ in range(40)]
    parts = [("".join(r.choice("ab.") for _ in range(r.randint(0, 9))), "/" + "".join(r.choice("xy/") for _ in range(r.randint(0, 30)))) for _ in range(300)]
    arrays = [np.array([*("." + h).encode(), url_filter.BORDER, *p.encode()], np.int64) for h, p in parts]
    got = url_filter.ShiftAnd([x.symbols() for x in rules]).match(arrays)
    star = lambda s: ".*".join(map(re.escape, s.split("*")))
    want = [[bool(re.fullmatch(rf"(?:[^\n]*\.)?{star(x.host)}\n{star(x.path)}.*", f"{h}\n{p}")) for x in rules] for h, p in parts]
    assert got.tolist() == want


def test_warc(spark):
    data = [(1, "http://a/", "<p>é</p>"), (5, None, "<p>é</p>"), (3, "u\r\nv", "<p>é</p>"), (2, "u", None), (4, "u", ""), (6, "u", "\r\n\r\n" + "z" * 400_000), (7, "u", "WARC/1.1\r\n\r\n\r\n")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("id", F.lit("clash")).repartition(3)
    index = warc.write_archives(df, frame_bytes=100, archive_bytes=300)
    same(rows(warc.digest(index), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), brute.op4([(a, c) for a, _, c in data]))
    names = {int(r.record_id.split(":")[2]): r.record_id for r in index.collect()}
    found = {r.record_id: bytes(r.record) for r in warc.fetch(index, [names[6], names[3]]).collect()}
    assert warc.parsed(found[names[6]])[1] == warc.HTTP + data[5][2].encode() and f"WARC-Refers-To: <{names[5]}>".encode() in found[names[3]]
    assert warc.digest(warc.write_archives(df.limit(0))).count() == 0
    least = warc.digest(warc.write_archives(df, min_bytes=5))
    assert rows(least.filter("record_type = 'revisit'"), "page_id") == [(1,), (3,)]
    odd = spark.createDataFrame([(None, "u", "q"), (9, "u", "q"), (9, "u", "q"), (9, "u", "other")], "page_id long, url string, html string")
    index = warc.write_archives(odd)
    assert index.select("record_id").distinct().count() == 4
    assert rows(warc.digest(index), "page_id", "record_type", "refers_to") == sorted([(None, "revisit", 9), *[(9, "response", None)] * 3], key=repr)


def test_warc_files_by_themselves(spark):
    """A Zstandard reader gets all records of a file, one after another, up to the skippable frame of the seek table."""
    import io
    import struct

    import zstandard
    from pyarrow import fs

    df = table(spark, "pages")
    index = warc.write_archives(df, frame_bytes=20_000, archive_bytes=60_000, date="2020-01-02T03:04:05Z").collect()
    assert len({r.path for r in index}) > 1 and max(r.frame for r in index) > 0
    for path in {r.path for r in index}:
        assert path.endswith(".warc.zst")
        system, place = warc.store(path)
        raw = system.open_input_file(place).read()
        end = sum(packed for _, packed, _ in warc.Archive(system.open_input_file(place)).places)
        assert struct.unpack("<II", raw[end : end + 8]) == (warc.SKIPPABLE, len(raw) - end - 8)
        text, at, seen = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw[:end]), read_across_frames=True).read(), 0, []
        while at < len(text):
            head, _, at = warc.parsed(text, at)
            seen.append(head[b"WARC-Record-ID"].strip(b"<>").decode())
            assert head[b"WARC-Date"] == b"2020-01-02T03:04:05Z"
        assert sorted(seen) == sorted(r.record_id for r in index if r.path == path)
    assert isinstance(system, fs.FileSystem)


TALK = [(1, 0, "system", "be <|im_end|> brief"), (1, 1, "user", r"a <\|im_start|> b <\\| c"), (1, 2, "assistant", "x " * 400), (1, 3, "user", None), (1, 4, "assistant", "y\n<|im_end|>\n"), (1, 5, "assistant", "z " * 30), (1, None, "user", "first"), (2, 0, "user", ""), (3, 0, None, "who"), (3, 0, "a\nb%0A<|", "role"), (None, 1, "assistant", "lost"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same")]


@pytest.mark.parametrize("budget,history", [(1024, 128), (120, 20), (40, 0)])
def test_chat(spark, budget, history):
    df = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash"))
    windows = chat.chat_windows(df, budget, history)
    want = [r for r in brute.op6([(c, -1 if t is None else t, r, x) for c, t, r, x in TALK]) if r[0] != -1]
    same(rows(chat.digest(windows), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"), want)
    assert windows.filter(f"n_tokens > {budget} AND n_turns > 1").isEmpty()
    assert chat.chat_windows(df.limit(0)).count() == 0


def test_chat_windows_repeat_history(spark):
    talk = [(1, k, "system" if not k else ("user", "assistant")[k % 2], f"word{k} " * 10) for k in range(30)]
    windows = chat.chat_windows(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"), 200, 40).orderBy("window").collect()
    assert len(windows) > 3
    for w in windows[1:]:
        assert w.formatted.startswith("<|im_start|>system\nword0 ") and w.own_from > 0 and min(s.start for s in w.loss) > w.own_from and w.n_tokens <= 200


def test_sentencepiece(spark, docs, pairs):
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs).drop("text"))
    assert dict(back.select("doc_id", "text").collect()) == {i: t or "" for i, t in pairs}
    assert sentencepiece_codec.digest(docs).filter("NOT round_trip").isEmpty()
    assert sentencepiece_codec.encode(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_codec.Vocabulary.of(open(sentencepiece_codec.DEFAULT_MODEL, "rb").read())


def test_viterbi_against_brute_force_and_the_library(spark, vocabulary):
    """On all texts of the table, a plain search over whole texts gives the same ids, and the public library's path is never better."""
    import numpy as np
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(sentencepiece_codec.DEFAULT_MODEL, "rb").read())
    proto.trainer_spec.model_type = 1
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.precompiled_charsmap = b""
    proto.normalizer_spec.remove_extra_whitespaces = False
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    ids = lambda t: np.frombuffer(sentencepiece_codec.encode_text(t, vocabulary), np.int32).tolist()
    lowest = min(vocabulary.scores.values()) - sentencepiece_codec.UNKNOWN_PENALTY
    score = lambda found: sum(lowest if library.is_byte(i) else library.get_score(i) for i in found)
    texts = [t for (t,) in plain(table(spark, "documents"), "text") if t and sentencepiece_codec.MARK not in t]
    assert len(texts) > 150
    for t in ["Hello world", "The quick brown fox, jumps over 12345 dogs.", *texts]:
        assert ids(t) == brute.op3(t, vocabulary)
        assert score(ids(t)) >= score(library.encode(t))
    assert [ids(t) for t in ("Hello world", "naïve façade 東京 🎉")] == [library.encode(t) for t in ("Hello world", "naïve façade 東京 🎉")]


@pytest.mark.parametrize("fan", [1, 2, 3])
def test_substring_dedup_over_several_levels(spark, docs, pairs, monkeypatch, fan):
    """Ranges that are split again and again, in groups of few batches, give the same answers."""
    monkeypatch.setattr(substring_dedup, "FAN_BITS", fan)
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 12_000)
    monkeypatch.setattr(substring_dedup, "RANGE_BYTES", 8_000)
    out = substring_dedup.digest(docs)
    same(rows(out, "doc_id", "n_words", "n_removed", "kept_sha256"), brute.op2(pairs))


def test_all_texts_are_streamed(spark, vocabulary, monkeypatch):
    """Without the dictionary of segments every character goes through ``feed``; the window stays small and the ids are the same."""
    v, fed, widest = vocabulary, [0], [0]
    texts = [t for (t,) in plain(table(spark, "documents"), "text") if t and sentencepiece_codec.MARK not in t]
    want = [sentencepiece_codec.encode_text(t, v) for t in texts]
    feed = sentencepiece_codec.Stream.feed

    def counted(self, chars):
        fed[0] += len(chars)
        out = feed(self, chars)
        widest[0] = max(widest[0], self.widest)
        return out

    monkeypatch.setattr(sentencepiece_codec.Stream, "feed", counted)
    monkeypatch.setattr(sentencepiece_codec, "_REMEMBERED_CHARS", -1)
    v.known.clear()
    v.older.clear()
    assert [sentencepiece_codec.encode_text(t, v) for t in texts] == want
    # A character that a boundary is found at is read again behind it.
    segments = sum(len(v.parts.findall(sentencepiece_codec.MARK + t.replace(" ", sentencepiece_codec.MARK))) for t in texts)
    assert fed[0] == sum(len(t) + 1 for t in texts) + segments - len(texts) and widest[0] < 4 * sentencepiece_codec._CHECK_EVERY
    # One stream over a whole text, without cuts at words, commits on the way and gives the same ids, too.
    for text, ids in list(zip(texts, want, strict=True))[:40]:
        stream, marked = sentencepiece_codec.Stream(v), sentencepiece_codec.MARK + text.replace(" ", sentencepiece_codec.MARK)
        early = [i for k in range(0, len(marked), 700) for i in feed(stream, marked[k : k + 700])]
        assert len(marked) < 700 or len(early) > 0.5 * len(ids) // 4
        assert sentencepiece_codec.np.array([*early, *stream.finish()], "int32").tobytes() == ids
        assert stream.widest < 4 * sentencepiece_codec._CHECK_EVERY


def test_ids_are_committed_where_paths_meet(spark, vocabulary, monkeypatch):
    """In the query, at least 99 % of the ids; and no remembered segment ends where a stream's paths didn't meet."""
    out = sentencepiece_codec.digest(table(spark, "documents")).agg(F.sum("n_settled"), F.sum("n_tokens"), F.bool_and("round_trip")).first()
    assert out[0] > 0.99 * out[1] and out[2]
    v, looked = vocabulary, [0, 0]
    v.known.clear()
    v.older.clear()
    settled = sentencepiece_codec.Stream.settled

    def counted(self):
        ids = settled(self)
        looked[0] += 1
        looked[1] += ids is not None
        return ids

    monkeypatch.setattr(sentencepiece_codec.Stream, "settled", counted)
    texts = [t for (t,) in plain(table(spark, "documents"), "text") if t]
    ids = [sentencepiece_codec.encode_text(t, v) for t in texts]
    assert looked[0] > 5000 and looked[1] == looked[0]
    assert [sentencepiece_codec.encode_text(t, v) for t in texts] == ids


def test_a_model_whose_pieces_cross_words(vocabulary):
    """Where paths don't meet before a mark, the stream goes on, and nothing is remembered across it."""
    from dataclasses import replace

    v = vocabulary
    pieces = {"▁": -2.0, "a": -2.5, "b": -2.5, "▁a": -3.0, "a▁b": -1.0, "▁a▁b▁": -1.5, "b▁a": -1.2}
    tree = {}
    for piece, score in pieces.items():
        node = tree
        for c in piece:
            node = node.setdefault(c, {})
        node[None] = score
    made = replace(v, ids={p: 300 + i for i, p in enumerate(pieces)}, scores=pieces, longest=5, pieces=tree, known={}, older={}, parts=v.parts)
    r = random.Random(2)
    for n in range(1, 60):
        text = "".join(r.choice("ab a b") for _ in range(n))
        want = brute.op3(text, made)
        for _ in range(2):
            assert sentencepiece_codec.np.frombuffer(sentencepiece_codec.encode_text(text, made), "int32").tolist() == want


def test_near_dup_of_repeated_rows(spark, monkeypatch):
    """However often a row repeats, with an id or without, each needed class brings its set once."""
    r = random.Random(9)
    base = [f"w{r.randint(0, 5000)}" for _ in range(200)]
    texts = [" ".join(base), " ".join([*base[:100], "x", *base[101:]]), " ".join([*base[:50], "y", *base[51:]])]
    rows = [(None, t) for t in texts for _ in range(300)] + [(7, texts[0])] * 300 + [(8, "alone and short")] * 5
    moved = []
    with_sets = near_dup._with_sets

    def counted(docs, classes, need, shingle):
        out = with_sets(docs, classes, need, shingle)
        moved.append((need.count(), out.count()))
        return out

    monkeypatch.setattr(near_dup, "_with_sets", counted)
    got = near_dup.near_dup(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), shingle=2).collect()
    assert len(got) == len(rows) and moved and all(a == b for a, b in moved)
    assert {(x.doc_id, x.component_id, x.kept) for x in got} == {(None, None, True), (7, None, False), (8, 8, True)}


def exact_links(texts, percent=80):
    """All pairs of sets of word pairs with 100 * intersection >= percent * union, by an index of prefixes: nothing is left out."""
    from collections import Counter, defaultdict

    sets = []
    for t in texts:
        w = brute.spaced(brute.lower(t or ""))
        sets.append({hash(p) for p in zip(w, w[1:])} or ({hash(tuple(w))} if w else set()))
    often = Counter(x for s in sets for x in s)
    index, links = defaultdict(list), []
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        s = sets[i]
        prefix = sorted(s, key=lambda x: (often[x], x))[: len(s) - -(-percent * len(s) // 100) + 1]
        for j in {j for x in prefix for j in index[x]}:
            if 100 * len(sets[j]) >= percent * len(s):
                common = len(s & sets[j])
                if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                    links.append((i, j))
        for x in prefix:
            index[x].append(i)
    return links


def test_near_dup_finds_all_links_of_ten_thousand_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = sorted(plain(docs, "doc_id", "text"))
    links = exact_links([t for _, t in rows])
    assert len(rows) == 10_000 and len(links) > 3000
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}
    assert {r.doc_id: r.component_id for r in near_dup.near_dup(docs, shingle=2).collect()} == want


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod("doc_id", F.lit(4)) == 0
    model = quality_classifier.fit(docs, labels.filter(~held))
    judged = quality_classifier.classify(docs.filter(held), model).join(labels, "doc_id")
    share = {(r.quality, r.toxic): r.kept for r in judged.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1, 0] > 0.97 and share[0, 0] < 0.1 and share[1, 1] < 0.5
    assert list(model.thresholds) == sorted(model.thresholds)


def test_classifier_finds_toxic_words(spark):
    """Of held-out rows labelled toxic with two or more toxic words, nearly none is kept; of good and clean ones nearly all."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    bad = F.array(*map(F.lit, "trash pathetic idiot worthless disgusting stupid clown scum loser moron".split()))
    held = F.pmod("doc_id", F.lit(4)) == 0
    judged = quality_classifier.classify(docs.filter(held), quality_classifier.fit(docs, labels.filter(~held))).join(labels, "doc_id")
    rows = judged.select("quality", "toxic", "kept", (F.size(F.array_intersect(F.split(F.lower("text"), "[^a-z]+"), bad)) >= 2).alias("plain"))
    toxic = rows.filter("toxic = 1 AND plain").agg(F.count("*"), F.avg(F.col("kept").cast("int"))).first()
    clean = rows.filter("quality = 1 AND toxic = 0").agg(F.avg(F.col("kept").cast("int"))).first()
    print("plainly toxic rows, share kept; share of clean rows kept:", *toxic, *clean)
    assert toxic[0] > 50 and toxic[1] < 0.05 and clean[0] > 0.98


def test_classifier_gradient_against_plain_python():
    """Likelihood spelt out text by text, and its gradient by finite differences."""
    import math

    import numpy as np

    r = np.random.default_rng(3)
    sizes = r.integers(1, 6, 40)
    flat, row, grades = r.integers(0, 9, sizes.sum()), np.repeat(np.arange(40), sizes), r.integers(0, 3, 40)
    by, high = 8 / np.sqrt(sizes), r.integers(0, 2, (40, 3)).astype(float)
    w, t, u = r.normal(0, 0.1, 9), np.array([-0.5, 0.7]), r.normal(0, 0.3, 3)

    def loss(w, t, u):
        total = 0.0
        for i in range(40):
            s = by[i] * sum(w[f] for f, x in zip(flat, row, strict=True) if x == i) + sum(u[k] * high[i, k] for k in range(3))
            below = lambda k: 0.0 if k < 0 else 1.0 if k > 1 else 1 / (1 + math.exp(s - t[k]))  # noqa: E731, B023
            total -= math.log(below(grades[i]) - below(grades[i] - 1))
        return total / 40

    value, *parts = quality_classifier.gradient(flat, row, by, high, grades, w, t, u)
    assert value == pytest.approx(loss(w, t, u))
    for at, got in enumerate(parts):
        for k in range(len(got)):
            up, down = [[x.copy() for x in (w, t, u)] for _ in range(2)]
            up[at][k] += 1e-6
            down[at][k] -= 1e-6
            assert got[k] == pytest.approx((loss(*up) - loss(*down)) / 2e-6, abs=1e-5)


def test_classifier_scores_against_plain_python(spark, docs):
    """The query's scores are sums of weights, spelt out; the tail is the logistic function of score less threshold."""
    import math

    labels = table(spark, "labels")
    small = table(spark, "documents").select("doc_id", "text")
    model = quality_classifier.fit(small, labels)
    hasher = quality_classifier.Hasher(model.bits)
    for r in quality_classifier.classify(small, model).collect():
        features = [int(f) for f in hasher((r.text or "").encode())]
        score = sum(model.weights[f] for f in features) * quality_classifier.SCALE / math.sqrt(max(1, len(features)))
        marks = sum(bool(model.marked[f]) for f in features)
        score += sum(float(s) for s, least in zip(model.steps, quality_classifier.MARK_STEPS, strict=True) if marks >= least)
        tails = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert (r.quality_score, r.expected_grade, r.p_top) == pytest.approx((score, sum(tails), tails[-1]))
        assert r.kept == (bool((r.text or "").strip()) and r.p_top >= model.cut)


def test_classifier_one_sided_labels(spark, docs):
    """Poor texts only: nothing counts as of the highest grade. Without labels nothing is rejected but blank texts."""
    poor = spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, poor)
    assert len(model.thresholds) == 2 and quality_classifier.classify(docs, model).filter("kept").isEmpty()
    free = quality_classifier.classify(docs, quality_classifier.fit(docs, poor.limit(0)))
    assert free.filter("NOT kept AND text RLIKE '[a-z]'").isEmpty()


def test_classifier_odd_tables(spark, docs):
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (4, None, 1), (None, 1, 1), (5, 0, None), (6, 0, 0), (7, 1, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for rated in (labels, labels.limit(0)):
        found = quality_classifier.classify(docs, quality_classifier.fit(docs, rated))
        assert found.count() == docs.count() and found.filter("kept AND (text IS NULL OR trim(text) = '')").isEmpty()
    assert quality_classifier.classify(docs.limit(0), quality_classifier.fit(docs.limit(0), labels)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = table(spark, "documents")
    columns = docs.columns
    from marketlane.llm.common import written

    for name, stage in p.STAGES:
        before = plain(docs, "doc_id", "text")
        out = stage(spark, docs, SF)
        if name != "tokens":
            docs = written(out, f"test-{name}")
            assert docs.columns == columns and docs.filter("n_chars <> char_length(text)").isEmpty()
        if name == "lines":
            want = {r[0]: r[3] for r in brute.op5(before)}
            assert all(brute.sha(t) == want[i] for i, t in plain(docs, "doc_id", "text"))
        if name == "near_duplicates":
            same(rows(docs, "doc_id"), [(r[0],) for r in brute.op7(before, 5) if r[3]])
        if name == "benchmark":
            found = brute.op1(before, plain(table(spark, "benchmark"), "item_id", "text"))
            texts = dict(plain(docs, "doc_id", "text"))
            assert set(texts) == {r[0] for r in found} and all(texts[i] == t for (i, t), r in zip(before, found, strict=True) if not r[5])
        if name == "tokens":
            assert out.count() == len(before) and out.filter("NOT round_trip").isEmpty()
    assert p.run(spark, SF).count() == len(before)


def test_pipeline_odd_rows(spark):
    import corpus_pipeline as p

    schema = T.StructType([*table(spark, "documents").schema.fields, T.StructField("kept", T.StringType()), T.StructField("spans", T.StringType())])
    odd = spark.createDataFrame([(None, None, None, None, None, "a", "b"), (1, "", "en", "s", 0, None, None), (1, "", "en", "s", 0, None, None)], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in p.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count()
