"""The training-data operators against SQL, brute force, exact round trips and awkward rows."""

import collections
import hashlib
import io
import itertools
import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import connect, differences
from trendloom.llm import components, exact_dedup, html_extract, jaccard, language, mixing, pieces, sharding, substring, topk, warc, workload
from trendloom.session import stage, stage_path

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, row string, id long, token long"


def _text(rng, n):
    return " ".join(rng.choice(["the", "of", "a", "x", "Ünder", "b" * 9, "and", "q1", "zz"]) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs, empty and long texts, copies, repeated rows and ids, columns with the operators' own names."""
    rng = random.Random(4)
    base, passage = _text(rng, 120), _text(rng, 50)
    near = base.split(" ")
    near[60] = "changed"
    texts = [None, "", " \n\t", base, base, base.upper(), " ".join(near), passage + " tail one", "head two " + passage, passage * 2, _text(rng, 30000), "a b", "A  b", "é ▁x \x00 日本"]
    rows = [(i if i != 5 else None, t, "en" if i % 2 else None, None if i % 3 else "s", True, "r", 1, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[3], rows[0]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(workload.CHECKS))
def test_same_rows_as_sql(spark, name):
    assert differences(workload.QUERIES[name](spark, FOLDER), workload.CHECKS[name], connect(FOLDER)) is None


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(spark, awkward, empty, keep):
    want = collections.defaultdict(list)
    for r in awkward.collect():
        want[r.text or ""].append(r.doc_id)
    got = collections.defaultdict(list)
    for r in exact_dedup.content_groups(awkward, keep=keep).collect():
        got[r.text_sha256].append(r)
    assert len(got) == len(want)
    for text, ids in want.items():
        found = got[hashlib.sha256(text.encode()).hexdigest()]
        order = sorted(ids, key=lambda i: (i is not None, i or 0))
        assert {r.keep_id for r in found} == {order[0] if keep == "smallest" else order[-1]}
        assert {r.group_size for r in found} == {len(ids)} and sum(r.kept for r in found) == 1
    left = exact_dedup.drop_copies(awkward, keep=keep)
    assert left.schema == awkward.schema and left.count() == len(want)
    assert exact_dedup.content_groups(empty).count() == exact_dedup.drop_copies(empty).count() == 0


def test_group_over_many_partitions(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) AS text")
    found = exact_dedup.content_groups(docs.repartition(8))
    assert found.filter("kept").count() == 4001
    assert found.filter("group_size = 2000 AND keep_id = 0").count() == 2000


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in rng.normal(size=6)] for _ in range(300)] + [[0.5] * 6] * 5
    rows = [(i, v, None) for i, v in enumerate(vectors)] + [(900, None, None), (901, [1.0, None], None), (902, [float("nan")], None), (None, [1.0], None), (903, [], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    got = topk.top_k(df, F.col("id") % 20 == 0, k=7, pivots=5, block_rows=16).collect()
    usable = {i: [math.floor(1024 * x) for x in v] for i, v in enumerate(vectors)} | {903: []}
    want = []
    for q in (i for i in usable if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)[:7]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert topk.top_k(df.filter("vec_id < 3"), F.col("id") == 0, k=7).count() == 2


def test_language(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = workload.op3_language(spark, "/root/testdata/sf0.01").filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert right / n > 0.95
    found = language.predict(awkward, language.fit(docs)).collect()
    assert len(found) == awkward.count()
    for r in found:
        lettered = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1 and (lettered or r.score == 0)
    for nothing in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        found = language.predict(awkward, language.fit(nothing))
        assert found.count() == awkward.count() == found.filter("lang_pred = 'und' AND score = 0").count()


def test_the_networks_score_decides_what_stays(spark, awkward):
    docs = spark.createDataFrame([(1, "plain words"), (2, "qqqq"), (3, "123"), (4, None)], "doc_id long, text string")
    network = language.Network(["a", "b"], hidden=3)
    network.weights = {k: np.zeros_like(v) for k, v in network.weights.items()}
    assert language.keep_known(docs, network).count() == 0
    network.weights["bias"][0] = 5
    assert sorted(r.doc_id for r in language.keep_known(docs, network).collect()) == [1, 2]
    assert sorted(r.doc_id for r in language.keep_known(docs, language.Network([])).collect()) == [1, 2]
    assert language.keep_known(awkward, network).schema == awkward.schema


def test_pipeline_on_empty_and_unlabelled_tables(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    docs.limit(30).withColumn("lang", F.lit(None).cast("string")).write.parquet(str(tmp_path / "unlabelled" / "documents.parquet"))
    docs.limit(5).withColumns({c: F.lit(None).cast("string") for c in ("lang", "text")}).write.parquet(str(tmp_path / "null" / "documents.parquet"))
    for folder, least in (("none", 0), ("unlabelled", 1), ("null", 0)):
        found = corpus_pipeline.run(spark, str(tmp_path / folder)).count()
        assert found >= least and (least or not found)
        assert workload.op3_language(spark, str(tmp_path / folder)).filter("lang_pred <> 'und'").count() == 0


def test_backpropagation_has_the_slopes_of_the_loss():
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 110, (6, 5)).astype(np.uint8), rng.integers(0, 2, 6)
    net = language.Network(["a", "b"], hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}

    def loss():
        ahead, back = [s[-1] for s in net._steps("f", x.T)], [s[-1] for s in net._steps("b", x.T[::-1])][::-1]
        return -sum(np.log(language._softmax(f @ net.weights["out_f"] + b @ net.weights["out_b"] + net.weights["bias"])[np.arange(6), y]).sum() for f, b in zip(ahead, back))

    total = {k: np.zeros_like(v) for k, v in net.weights.items()}
    ahead, back = list(net._steps("f", x.T)), list(net._steps("b", x.T[::-1]))
    grads = []
    for f, b in zip(ahead, back[::-1]):
        p = language._softmax(f[-1] @ net.weights["out_f"] + b[-1] @ net.weights["out_b"] + net.weights["bias"])
        p[np.arange(6), y] -= 1
        grads.append(p @ net.weights["out_f"].T)
    net._backward("f", ahead, grads, total)
    for name in ("state_f", "gate_state_f", "input_f"):
        at = np.unravel_index(np.abs(total[name]).argmax(), total[name].shape)
        old, step = net.weights[name][at], 1e-3
        net.weights[name][at] = old + step
        up = loss()
        net.weights[name][at] = old - step
        slope = (up - loss()) / (2 * step)
        net.weights[name][at] = old
        assert slope == pytest.approx(total[name][at], rel=0.05, abs=1e-3)


def test_pieces_round_trip_and_are_distinct(spark, awkward, empty):
    sampled = pieces.encode(awkward, k=3).select("row.text", F.explode("samples").alias("s"))
    found = pieces.decode(sampled, F.col("s.tokens")).collect()
    assert all(r.decoded == (r.text or "") for r in found)
    for text, own in itertools.groupby(sorted(found, key=lambda r: (r.text or "", r.s["rank"])), key=lambda r: r.text or ""):
        own = list({r.s["rank"]: r for r in own}.values())
        assert len({tuple(r.s.tokens) for r in own}) == len(own) <= 3
        assert [r.s.perturbed for r in own] == sorted((r.s.perturbed for r in own), reverse=True)
    assert pieces.encode(empty).count() == 0
    kept = pieces.encode(awkward, k=3, keep=["doc_id"])
    assert kept.schema["row"].dataType.names == ["doc_id"]
    same = pieces.encode(awkward, k=3).select("row.doc_id", "samples").collect()
    assert sorted(map(str, kept.select("row.doc_id", "samples").collect())) == sorted(map(str, same))
    flat = kept.select("row.doc_id", F.explode("samples").alias("s")).select("doc_id", "s.tokens")
    assert pieces.decode(flat, F.col("tokens"), keep=["doc_id"]).columns == ["doc_id", "decoded"]


def test_pieces_are_drawn_by_their_probabilities():
    vocabulary, n, text = pieces.Vocabulary(), 6000, "the nt"
    ids = {p: i for i, p in enumerate(vocabulary.surface)}
    weight = {}

    def segment(rest, tokens, w):
        if not rest:
            weight[tokens] = w
        for end in range(1, len(rest) + 1):
            token = ids.get(rest[:end].encode())
            state = 0
            for c in rest[:end].replace(" ", "▁"):
                state = int(vocabulary.step(np.array([state]), np.array([ord(c)]))[0]) if state >= 0 else -1
            if state >= 0 and vocabulary.token[state] >= 0 and token is not None:
                segment(rest[end:], (*tokens, int(vocabulary.token[state])), w * math.exp(vocabulary.weight[state]))

    segment(" " + text, (), 1.0)
    total = sum(weight.values())
    lattices, found = pieces.sample(pieces.Pool(vocabulary), [text] * n, np.arange(n) * 7 + 1, 2)
    first = collections.Counter(tuple(lattices.token[own[0].edges].tolist()) for own, _ in found)
    pairs = collections.Counter(tuple(tuple(lattices.token[p.edges].tolist()) for p in own) for own, _ in found)
    for own, _ in found[:50]:
        for p in own:
            assert math.exp(p.logp) == pytest.approx(weight[tuple(lattices.token[p.edges].tolist())] / total, rel=1e-6)
    for tokens, seen in first.most_common(2):
        assert seen / n == pytest.approx(weight[tokens] / total, abs=0.03)
    (a, b), seen = pairs.most_common(1)[0]
    pa, pb = weight[a] / total, weight[b] / total
    assert seen / n == pytest.approx(pa * pb / (1 - pa), abs=0.03)


@pytest.mark.parametrize("text", ["a    b", "  a  ", "   ", "f:\n        x", "a \u2581  b", "\u2603   \u2603"])
def test_runs_of_spaces_have_all_segmentations(text):
    vocabulary, mark = pieces.Vocabulary(), pieces.SPACE
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
    ids = {model.id_to_piece(i): i for i in plain}
    weight = {}

    def segment(rest, tokens, w):
        if not rest:
            weight[tokens] = w
        elif rest[0] == mark or rest[0].replace(" ", mark) not in ids:
            segment(rest[1:], (*tokens, *[model.piece_to_id(f"<0x{b:02X}>") for b in rest[0].encode()]), w)
        else:
            for end in range(1, len(rest) + 1):
                if mark not in rest[:end] and (token := ids.get(rest[:end].replace(" ", mark))) is not None:
                    segment(rest[end:], (*tokens, token), w / (1 - model.get_score(token)))

    segment(" " + text, (), 1.0)
    total = sum(weight.values())
    lattices, [(found, left)] = pieces.sample(pieces.Pool(vocabulary), [text], np.array([5]), len(weight) + 1)
    drawn = {tuple(lattices.token[p.edges].tolist()): math.exp(p.logp) for p in found}
    certain = {t: w / total for t, w in weight.items() if w / total > 1e-9}
    assert drawn.keys() <= weight.keys() and certain.keys() <= drawn.keys()
    assert all(p == pytest.approx(weight[t] / total, rel=1e-6) for t, p in drawn.items())
    assert mark in text or tuple(model.encode(text)) in drawn


def test_lattices_kept_from_earlier_batches_change_nothing(monkeypatch):
    vocabulary = pieces.Vocabulary()
    batches = [["one two three", "two  two", ""], ["three four \u2603", "one"], [""], ["four five one", "x" * 50]]
    seeds = np.arange(3) + 5

    def drawn(pools):
        out = []
        for texts, pool in zip(batches, pools):
            lattices, found = pieces.sample(pool, texts, seeds[: len(texts)], 3)
            out.append([[(lattices.token[p.edges].tolist(), p.value) for p in paths] for paths, _ in found])
        return out

    alone = drawn([pieces.Pool(vocabulary) for _ in batches])
    kept = drawn([pieces.Pool(vocabulary)] * len(batches))
    monkeypatch.setattr(pieces, "KEPT_EDGES", 1)
    assert [[[t for t, _ in p] for p in b] for b in kept] == [[[t for t, _ in p] for p in b] for b in alone]
    values = lambda found: [v for b in found for p in b for _, v in p]
    assert np.allclose(values(kept), values(alone))
    assert drawn([pieces.Pool(vocabulary)] * len(batches)) == alone


def test_shards(spark, awkward, empty):
    written = sharding.write_shards(awkward, stage_path(spark), shards=4, bucket_bytes=2000)
    rows = sharding.with_slots(written).collect()
    assert sorted(str(tuple(r.record)) for r in rows) == sorted(str(tuple(r)) for r in awkward.collect())
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    again = sharding.write_shards(awkward.repartition(3), stage_path(spark), shards=4, bucket_bytes=2000)
    place = lambda df: sorted((r.shard, r.slot, str(tuple(r.record))) for r in sharding.with_slots(df).collect())
    assert place(written) == place(again)
    moved = spark.range(2000).select(sharding.shard_of(F.col("id"), 16).alias("a"), sharding.shard_of(F.col("id"), 17).alias("b")).filter("a <> b")
    assert 0 < moved.count() < 250 and moved.filter("b <> 16").count() == 0
    assert sharding.write_shards(empty, stage_path(spark)).count() == 0


def test_records_are_not_shuffled_for_their_slots(spark, awkward):
    written = sharding.write_shards(awkward, stage_path(spark), shards=4, bucket_bytes=2000)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        # As with shards too large for Spark to guess that their bucket table is small.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = sharding.with_slots(written)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_archives(spark, awkward, empty):
    pages = awkward.selectExpr("doc_id AS page_id", "if(doc_id = 3, 'u\\r\\nv', null) AS url", "text AS html", "kept AS record_type")
    back = warc.read_archives(warc.write_archives(pages, archive_bytes=500)).collect()
    assert len(back) == awkward.count() and not any(r.error for r in back)
    by_id = {r.record_id: r for r in back}
    for r in awkward.collect():
        record, body = by_id["" if r.doc_id is None else str(r.doc_id)], (r.text or "").encode()
        assert record.payload_bytes == len(body) and record.payload_digest == warc.payload_digest(body)
        assert bytes((by_id[record.refers_to] if record.refers_to else record).payload) == body
    assert by_id["0"].refers_to == "1" and by_id["1"].record_type == "response" and by_id["3"].refers_to == "4"
    assert warc.write_archives(empty, "doc_id", "source", "text").count() == 0


def test_archive_frames_are_checked():
    good = warc.render(1, "u", b"body", warc.payload_digest(b"body"), None, "1970-01-01T00:00:00Z")
    assert warc.parse(good)["payload"] == b"body"
    for bad in (good[:-1], good.replace(b"body", b"BODY"), good.replace(b"WARC/1.1", b"WARD/1.1"), good.replace(b"WARC-Date", b"X-Date"), good.replace(b"response\r\nWARC-Rec", b"revisit\r\nWARC-Rec")):
        with pytest.raises(warc.BadRecord):
            warc.parse(bad)
    words = warc.train_dictionary([good] * 3)
    codec = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words))
    archive = struct.pack("<II", warc.DICTIONARY_FRAME, len(words)) + words + codec.compress(good) + codec.compress(good)
    assert list(warc.records(io.BytesIO(archive))) == [good, good]
    with pytest.raises(warc.BadRecord):
        list(warc.records(io.BytesIO(archive[:-3])))


def test_article_text(spark):
    pages = [
        (1, "u", '<html><title>T</title><body><nav><a href="/">Home</a></nav><article><h1>A &amp; B</h1><p>One,  two\n three.<br>Four.<p>Five six.'
         '</article><div class="comments"><p>Nice post, really.</p></div><footer>&copy; 2020</footer>'),
        (2, None, None),
        (3, "u", ""),
        (4, "u", '<body><div class="cookie-notice">We use cookies.</div><div class="content"><p>' + "word, and more. " * 5000 + "</p></div><script>x<y</script></body>"),
    ]
    found = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found[1].text == "A & B\nOne, two three. Four.\nFive six."
    assert found[2].text == found[3].text == "" and found[2].n_chars == 0 and found[2].url is None
    assert found[4].text == ("word, and more. " * 5000).strip() and found[4].n_chars == len(found[4].text)


def test_any_page_is_read(spark):
    words = "Some words, and more of them. " * 9
    marks = ["<![ endif]>", "<![foo[x]]>", "<![if !IE]>", "<![CDATA[x]]>", "<!x y>"]
    pages = [(i, None, f"<body><article><p>{words}</p>{m}<p>{words}</p></article></body>") for i, m in enumerate(marks)]
    for value in ('="[\'top\',\'top\']"', '="12.5"', "", '=""', '="1"'):
        pages.append((len(pages), None, f"<body><article data-y{value}><p>{words}</p><p>{words}</p></article></body>"))
    pages.append((len(pages), None, f"<body><article><p>{words}</p><svg><![CDATA[a > <b>]]></svg><p>{words}</p></article></body>"))
    pages.append((len(pages), None, f"<body><article><p>{words}</p><p>{words}</p><![ endif"))
    found = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(found) == len(pages) and set(found.values()) == {f"{words.strip()}\n{words.strip()}"}


@pytest.mark.parametrize("page, heading", [
    ("<html><head><title>T</title><body><article>{}</article>", ""),
    ("<head><meta charset=utf-8><title>T</title><script>x()</script><article>{}</article>", ""),
    ("<head><title>T</title></head><body><form id=aspnetForm><article>{}</article></form></body>", ""),
    ("<body><form><ul class=menu><li><a>Home</a></li></ul><div class=content><h1>A b c</h1>{}</div><div class=footer>x</div></form></body>", "A b c\n"),
    ("<body><form>{}</form></body>", ""),
    ("<head><title>T</title></head><body><article>{}<form class=newsletter><p>Sign up for mail, now.</p></form></article></body>", ""),
])
def test_articles_in_open_heads_and_wide_forms(page, heading):
    words = ("Some words, and more of them. " * 9).strip()
    assert html_extract.texts([page.format(f"<p>{words}</p>" * 3)], html_extract.trained()) == [heading + "\n".join([words] * 3)]


@pytest.mark.parametrize("page", [
    '<body><div class="container"><div class="row"><div class="col-md-8"><h1>Title here</h1>{}</div></div></div></body>',
    '<body><nav><a href="/">Home</a></nav><div class="row"><h1>Title here</h1>{}</div><footer>x</footer></body>',
    '<body><div class="rich"><h1>Title here</h1>{}</div></body>',
    '<body><div class="hentry layout core md"><h1>Title here</h1>{}</div><div class="sidebar"><p>Read this, too.</p></div></body>',
    '<body><x-story class="copy qzj"><h1>Title here</h1>{}</x-story></body>',
])
def test_names_not_trained_on_say_nothing(page):
    words = ("Some words, and more of them. " * 5).strip()
    assert html_extract.texts([page.format(f"<p>{words}</p>" * 2)], html_extract.trained()) == [f"Title here\n{words}\n{words}"]


def test_code_is_part_of_the_article():
    words = ("Some words, and more of them. " * 5).strip()
    page = f"<body><nav><a href=/>Home</a></nav><article><h1>Title here</h1><p>{words}</p><pre><code>def f(x):\n    return x + 1\n</code></pre><p>{words}</p></article></body>"
    assert html_extract.texts([page], html_extract.trained()) == [f"Title here\n{words}\ndef f(x): return x + 1\n{words}"]


class CountedList(list):
    """A list that counts the elements looked at by place."""

    reads = 0

    def __getitem__(self, at):
        CountedList.reads += 1
        return list.__getitem__(self, at)


@pytest.mark.parametrize("part", ["<b></i>", "<b><hr>", "<p><button><b><hr>", "<li><b></p>", "<div></span>"])
def test_open_elements_are_not_searched(part):
    reads = []
    for n in (500, 1000):
        dom = html_extract.Dom(labelled=False)
        dom.tag, CountedList.reads = CountedList(dom.tag), 0
        dom.feed(part * n)
        dom.close()
        reads.append(CountedList.reads)
    assert reads[1] <= 2 * reads[0] + 10


def test_text_ends_an_open_head():
    dom = html_extract.parse("<html><head> <title>T</title>\nSome words", labelled=False)
    assert [dom.tag[node] for node, text in dom.pieces if text and "words" in text] == ["html"]


def test_page_model_on_pages_not_trained_on():
    doms = [html_extract.parse(x) for x in html_extract.labelled_pages(100, 77)]
    model = html_extract.trained()
    article = model.article(model.forest(doms))
    assert ((article > 0.5) == np.concatenate([d.label for d in doms])).mean() > 0.97


def test_marginals_are_exact():
    dom = html_extract.parse("<div><p>a</p><p>b <b>c</b></p></div>")
    tags = {tag: i for i, tag in enumerate(["div", "p", "b"], 1)}
    forest, rng = html_extract.Forest([dom], {}, tags), np.random.default_rng(1)
    unary, steps = rng.normal(size=forest.count), rng.normal(size=(4, 2, 2))
    mass = np.zeros(forest.count)
    total = 0.0
    for y in itertools.product((0, 1), repeat=forest.count):
        score = sum(u for u, v in zip(unary, y) if v) + sum(steps[forest.kind[i], y[p], y[i]] for i, p in enumerate(forest.parent) if p >= 0)
        total += math.exp(score)
        mass += math.exp(score) * np.array(y)
    assert forest.marginals(unary, steps)[0] == pytest.approx(mass / total)


def test_mixing(spark, awkward, empty):
    rows = mixing.with_copies(awkward).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == awkward.count() and all(0 <= r.copies <= 2 and r.target <= 2 * r.source_size for r in rows)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    mixed = mixing.mix(awkward)
    assert mixed.schema == awkward.schema and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(empty).count() == 0


def test_repeated_passages(spark, awkward, empty):
    docs = awkward.collect()
    words = [WORDS.findall(r.text or "") for r in docs]
    seen = collections.Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for r, w in zip(docs, words):
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want.append((str(r.doc_id), len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring.drop_repeats(awkward, part_bytes=20000).collect()]
    assert sorted(got) == sorted(want) and any(n for _, _, n, _ in got)
    assert substring.drop_repeats(empty).count() == 0


def _components(rows, width, least):
    sets = []
    for ident, text in rows:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
    group = {ident: ident for ident, _ in rows}
    for _ in rows:
        for (a, x), (b, y) in itertools.combinations([(i, s) for (i, _), s in zip(rows, sets) if i is not None], 2):
            if x and y and 100 * len(x & y) >= least * len(x | y):
                group[a] = group[b] = min(group[a], group[b])
    return sorted((str(i), len(s), str(group[i] if i is not None else None)) for (i, _), s in zip(rows, sets))


@pytest.mark.parametrize("width, least", [(3, 90), (5, 80)])
def test_near_duplicates(spark, width, least):
    rng, rows = random.Random(9), []
    for family in range(4):
        base = _text(rng, 90).split(" ")
        chain = base
        for copy in range(7):
            edited = list(chain if family < 2 else base)
            for _ in range(rng.randrange(3)):
                edited[rng.randrange(len(edited))] = f"e{rng.random()}"
            chain = edited
            rows.append((100 - len(rows), " ".join(edited)))
    rows += [(200, None), (201, ""), (202, "A b"), (203, "a  B"), (None, rows[0][1]), (204, " ".join(rows[0][1].split(" ")[:9]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_duplicates(df, width=width, least=least).collect())
    assert got == _components(rows, width, least)
    left = jaccard.drop_near_copies(df, width=width, least=least)
    assert left.count() == len({c for _, _, c in got})


@pytest.mark.parametrize("width, least", [(1, 90), (1, 80), (3, 90), (1, 50)])
def test_linked_sets_are_equal_in_a_block(width, least):
    """Sets of every size, with as many n-grams exchanged, added or left out as the threshold allows."""
    rng, linked = random.Random(width * least), 0
    for size in [*range(1, 60), *range(60, 400, 13)]:
        texts = []
        base = [f"w{rng.random()}" for _ in range(size)]
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randrange(size * (100 - least) // 100 + 2)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randrange(2)] = [f"v{rng.random()}"] * rng.randrange(2)
            texts.append(" ".join(words))
        found = jaccard.Incidence(pa.array(texts, pa.large_string()), width)
        sets = [set(found.tokens[found.owner == i].tolist()) for i in range(len(texts))]
        tokens = [set() for _ in texts]
        for docs, each in jaccard._equal_blocks(found, np.ones(len(texts), bool), least):
            for d, t in zip(docs.tolist(), each.tolist()):
                tokens[d].add(t)
        for i, j in itertools.combinations(range(len(texts)), 2):
            if sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                linked += 1
                assert tokens[i] & tokens[j]
    assert linked > 100


def test_blocks_that_two_sets_share_across_batches():
    rng = random.Random(2)
    rows = sorted((rng.randrange(60), rng.randrange(40)) for _ in range(100))
    want = sorted({r for r in rows if len({s for t, s in rows if t == r[0]}) > 1})
    for _ in range(30):
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(20))
        batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        got = jaccard.shared(jaccard._columns(["token", "set"], [pa.array([r[i] for r in b], pa.int64()) for i in (0, 1)]) for b in batches)
        assert [r for b in got for r in zip(b.column("token").to_pylist(), b.column("set").to_pylist())] == want


def test_blocks_of_the_same_sets_across_batches():
    rng = random.Random(5)
    rows = sorted({(rng.randrange(30) * 7 - 99, rng.choice([-(2**62), -1, 0, 8])) for _ in range(90)})
    groups = {t: [s for u, s in rows if u == t] for t, _ in rows}
    for _ in range(30):
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(20))
        batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        found = jaccard.with_groups(jaccard._columns(["token", "set"], [pa.array([r[i] for r in b], pa.int64()) for i in (0, 1)]) for b in batches)
        got = [tuple(r.values()) for b in found for r in b.to_pylist()]
        assert [r[:2] for r in got if r[2] is None] == rows
        whole = {t: (low, w) for t, low, w in got if w is not None}
        assert len(got) - len(rows) == len(whole) == len(groups) and all(whole[t][0] == groups[t][0] for t in groups)
        assert all((whole[t] == whole[u]) == (groups[t] == groups[u]) for t in groups for u in groups)


def test_rows_of_blocks_are_shuffled_without_sketches(spark, monkeypatch):
    """Twelve near copies meet in hundreds of blocks; what is written for these blocks has no sketches, and each set of copies meets once."""
    rng = random.Random(6)
    base = _text(rng, 300).split(" ")
    texts = []
    for i in range(12):
        words = list(base)
        words[rng.randrange(len(words))] = f"changed{i}"
        texts.append((i, " ".join(words)))
    written = []
    monkeypatch.setattr(jaccard, "stage", lambda df: written.append(stage(df)) or written[-1])
    found = jaccard.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), width=5, least=80).collect()
    assert {r.component_id for r in found} == {0}
    blocks = [df for df in written if "token" in df.columns]
    assert not any("k0" in df.schema.simpleString() for df in blocks)
    assert 2 * blocks[1].count() < blocks[0].filter("whole IS NULL").count()


def test_large_sets_are_discarded_by_wide_sketches(spark, monkeypatch):
    """Long texts with a passage in common meet in blocks; the overlap is counted for the linked ones alone, also where sketches differ in length."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(300))
    texts = [" ".join(f"w{rng.random()}" for _ in range(1700)) + " " + passage for _ in range(4)]
    texts += [texts[0] + "".join(f" e{i}" for i in range(200)), texts[1] + " end"]
    written = []
    monkeypatch.setattr(jaccard, "stage", lambda df: written.append(stage(df)) or written[-1])
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=1, least=80).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0, 5: 1}
    close = [df for df in written if df.columns == ["a", "b", "low", "high", "total"]]
    assert sorted(tuple(r)[:2] for df in close[1::2] for r in df.collect()) == [(0, 4), (1, 5)]
    sizes = {r.n: len(r.wide) for r in written[0].collect()}
    assert len(set(sizes.values())) == 2


def test_near_duplicates_of_awkward_rows(spark, awkward, empty):
    found = jaccard.near_duplicates(awkward).collect()
    assert len(found) == awkward.count() and all((r.component_id is None) == (r.doc_id is None) for r in found)
    assert jaccard.near_duplicates(empty).count() == 0


def test_near_copies_under_repeated_ids(spark):
    rng = random.Random(3)
    first, other, third = (_text(rng, 60) for _ in range(3))
    rows = [(1, first), (2, first + " end"), (2, other), (3, other + " end"), (3, third), (4, None), (5, ""), (None, first), (6, third + " a"), (6, third + " b")]
    left = jaccard.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), width=5, least=80).collect()
    wanted = [rows[i] for i in (0, 2, 4, 5, 6, 7)]
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, wanted))


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 200).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(500, 501)], "a long, b long"))
    found = dict(map(tuple, components.components(links).collect()))
    assert {found[i] for i in range(1, 201)} == {1} and found[501] == 500


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, docs, FOLDER)
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count() and corpus_pipeline.run(spark, FOLDER).count() == docs.count()
