"""The registered queries and the pipeline over the given tables, against SQL or brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from measure_rollup.llm import language_id, mixing, queries, toxicity
from test_small_cases import _brute_vectors, _exact, _near, _packed

TABLES = Path("/root/testdata")
SMALL, LARGER = TABLES / "sf0.001", TABLES / "sf0.01"

pytestmark = pytest.mark.skipif(not LARGER.is_dir(), reason="the tables are missing")


def table(folder, sql):
    connection = duckdb.connect()
    for file in folder.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    result = connection.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def _sorted(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in found), key=repr)


@pytest.mark.parametrize("name", [name for name, query in queries.QUERIES.items() if query.sql])
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name].run(spark, str(LARGER))
    columns, expected = table(LARGER, queries.QUERIES[name].sql)
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.columns, map(tuple, df.collect())) == _sorted(columns, expected)


def test_near_duplicates(spark):
    data = table(SMALL, "select doc_id, text from documents")[1]
    found = queries.QUERIES["op1_near_duplicates"].run(spark, str(SMALL)).collect()
    assert {r.doc_id: r.group_id for r in found} == _near(data)


def test_embeddings(spark):
    data = table(SMALL, "select vec_id, embedding, label from embeddings")[1]
    found = queries.QUERIES["op3_embedding_duplicates"].run(spark, str(SMALL)).collect()
    assert sorted(map(tuple, found), key=repr) == _brute_vectors(data)


def test_packing(spark):
    _, by_sequence = _packed(spark.read.parquet(str(SMALL / "documents.parquet")))
    totals = [sum(n for _, n in spans) for spans in by_sequence.values()]
    assert sum(totals) > 0.9 * 2048 * (len(totals) - 8)  # but for the last ones of each task


def test_token_counts(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    data = table(LARGER, "select doc_id, coalesce(text, '') from documents")[1]
    found = queries.QUERIES["op9_token_counts"].run(spark, str(LARGER)).collect()
    expected = [(i, len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in data]
    assert sorted(map(tuple, found)) == sorted(expected)


def _held_out(doc_id, divisor, value):
    return zlib.crc32(str(doc_id).encode()) % divisor == value


@pytest.mark.parametrize(
    "name, column, label, divisor, value, least",
    [
        ("op7_language", "lang_pred", "lang from documents", 5, 0, 0.95),
        ("op8_quality", "predicted", "quality from labels", 5, 0, 0.93),
        ("op2_toxicity", "predicted", "toxic from labels", 3, 1, 0.8),
    ],
)
def test_held_out_accuracy(spark, name, column, label, divisor, value, least):
    truth = dict(table(LARGER, f"select doc_id, {label}")[1])
    found = queries.QUERIES[name].run(spark, str(LARGER)).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for (i,) in table(LARGER, "select doc_id from documents")[1])
    assert all(r.held_out == _held_out(r.doc_id, divisor, value) and 0 <= r.score <= 1 for r in found)
    right = [r[column] == truth[r.doc_id] for r in found if r.held_out and r.doc_id in truth]
    assert sum(right) >= least * len(right)


def test_warc(spark):
    pages = table(LARGER, "select page_id, url, html from pages")[1]
    found = queries.QUERIES["op6_warc_derivatives"].run(spark, str(LARGER)).collect()
    assert Counter(r.warc_type for r in found) == {"metadata": len(pages), "conversion": len(pages)}
    assert len({r.record_id for r in found}) == len(found)
    payload = {
        "sha1:" + __import__("base64").b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): (u, h)
        for _, u, h in pages
    }
    text = {r.refers_to: r.block for r in found if r.warc_type == "conversion"}
    for r in found:
        assert r.content_length == len(r.block.encode())
        if r.warc_type == "metadata":
            digest = r.block.partition("source-payload-digest: ")[2].partition("\r\n")[0]
            url, html = payload[digest]
            assert r.target_uri == url
            assert text[r.refers_to] == _page_text(html or "")


def _page_text(html):
    """The text of a page, by the standard library's parser where it and the operator agree."""
    import html as entities
    import re

    html = re.sub(r"(?is)<!--.*?-->|<(head|script|style|noscript|template)\b.*?</\1\s*>", "\n", html)
    blocks = "address article aside blockquote br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6"
    blocks = {*blocks.split(), *"header hr li main nav ol p pre section table td th tr ul".split()}
    out = []
    for part in re.split(r"(<[a-zA-Z/!?][^>]*>)", html):
        name = re.match(r"</?([a-zA-Z][a-zA-Z0-9]*)", part)
        if name and part.endswith(">"):
            out.append("\n" if name[1].lower() in blocks else "")
        elif not re.fullmatch(r"<[!?/][^>]*>", part):
            out.append(part)
    lines = [re.sub("[ \t\f\r\x0b\xa0]+", " ", x).strip(" ") for x in entities.unescape("".join(out)).split("\n")]
    return "\n".join(x for x in lines if x)


# the pipeline


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and returned."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(str(SMALL / "documents.parquet"))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(SMALL)).write.parquet(str(root / name))
        found = spark.read.parquet(str(root / name))
        out[name] = docs, found
        docs = found
    return out


def _pairs(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_language_stage(stages):
    before, after = stages["language"]
    kept = {i for i, t, *_ in _pairs(before) if t and any(c.isalpha() for c in t)}
    assert after.schema == before.schema
    assert {i for i, *_ in _pairs(after)} == kept  # every text with letters here is in a known language


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    assert {i for i, *_ in _pairs(after)} == {r[1] for r in _exact(_pairs(before))}


def test_near_stage(stages):
    before, after = stages["near_dedup"]
    assert {i for i, *_ in _pairs(after)} == set(_near(_pairs(before)).values())


def _mixed(data):
    """Margins met by many rounds of fitting in plain numpy, half of the tokens by bisection."""

    def topic(t):
        return next((n for mark, n in ((" | ", "table"), ("icense", "license"), ("@", "contact")) if mark in t), "prose")

    cells = Counter()
    of = {}
    for i, t, lang, source in data:
        of[i] = (source, lang, topic(t or ""))
        cells[of[i]] += len((t or "").split())
    names = [c for c in cells if cells[c]]
    seen = np.array([cells[c] for c in names], float)
    weight = seen.copy()
    aims = []
    for k, name in enumerate(mixing.MARGINS):
        margin = Counter()
        for c, w in zip(names, seen):
            margin[c[k]] += w
        raw = {v: (w / seen.sum()) ** mixing.POWERS[name] for v, w in margin.items()}
        aims.append({v: w / sum(raw.values()) for v, w in raw.items()})
    for _ in range(100):
        for k, aim in enumerate(aims):
            held = Counter()
            for c, w in zip(names, weight):
                held[c[k]] += w
            weight = np.array([w * aim[c[k]] / held[c[k]] for c, w in zip(names, weight)])
    factor = dict(zip(names, weight / (seen / seen.sum())))
    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        enough = sum(cells[c] * min(1, f * middle) for c, f in factor.items()) > sum(cells.values()) / 2
        low, high = (low, middle) if enough else (middle, high)
    draw = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) / 2**32 for i in of}
    return {i for i, c in of.items() if draw[i] < factor.get(c, 1.0) * low}


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    assert {i for i, *_ in _pairs(after)} == _mixed(_pairs(before))


def test_packing_stage(stages):
    before, after = stages["packing"]
    found = defaultdict(int)
    for r in after.collect():
        found[r.doc_id] += r.length
        assert r.doc_tokens >= r.start + r.length
    assert set(found) == {i for i, *_ in _pairs(before)}
    _packed(before)


def test_run_is_the_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = corpus_pipeline.run(spark, str(SMALL)).select(columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages["packing"][1].select(columns).collect()))


def test_language_profiles_are_bounded(spark):
    docs = spark.read.parquet(str(SMALL / "documents.parquet"))
    known = language_id.learn(docs, size=50, per_language=5)
    assert known.ranks.shape[1] == 4 and (known.ranks.max(axis=0) == 49).all()


def test_the_network_alone_tells_toxic_documents():
    """Learned from words and gradients only, no counts: held-out documents of sf0.1, a tenth of whose labels are noise."""
    folder = "/root/testdata/sf0.1"
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    labels = pq.read_table(f"{folder}/labels.parquet", columns=["doc_id", "toxic"]).to_pydict()
    label = dict(zip(labels["doc_id"], labels["toxic"]))
    found = [(i, t or "", label[i]) for i, t in zip(docs["doc_id"], docs["text"]) if label.get(i) is not None]
    learned = [r for r in found if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    network = toxicity.train([t for _, t, _ in learned], np.array([x for *_, x in learned]))
    others = [r for r in found if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    scores = np.array(list(toxicity.Scorer(network).scores([t for _, t, _ in others])))
    toxic = np.array([x for *_, x in others]) == 1
    above = (scores[toxic][:, None] > scores[~toxic]).mean() + (scores[toxic][:, None] == scores[~toxic]).mean() / 2
    assert above >= 0.9
