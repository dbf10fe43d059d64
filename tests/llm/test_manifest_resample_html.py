"""Merkle manifest, importance resampling and HTML extraction against brute force."""

import hashlib
import html
import math
import re
import zlib

import pytest
from oracle_check import connect
from pyspark.sql import functions as F

import orderloom.llm.resample as resample
from orderloom.llm import queries
from orderloom.llm.html_extract import extract_text, main_text, text_runs
from orderloom.llm.merkle import Subtree, merkle_manifest
from orderloom.llm.resample import bucket_numbers, importance_resample, kth_key
from orderloom.llm.scratch import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
TEXTS = [
    (1, "one two", "en"), (2, None, "en"), (3, "", "en"), (4, "  \n", "en"), (5, LONG, "en"),
    (None, "one two", "en"), (None, "x", None), (7, "é ｗide", None), (7, "é ｗide", None),
    (7, "other", None), (8, "lone", "de"), (9, "a", ""), (10, "b", ""), (2**60 + 1, "big", "en"),
    *[(100 + i, f"shared words here {i} " * (i % 9), "en") for i in range(40)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, g, "s" if d != 3 else None, None if d == 4 else len(t or "")) for d, t, g in TEXTS]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns(
        {n: F.lit(1) for n in ("g", "n", "size", "digest", "row", "key", "score", "rank", "b", "all")}
    )


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, fan_out):
    found = [nodes]
    while len(nodes) > 1:
        nodes = [sha(*nodes[i : i + fan_out]) for i in range(0, len(nodes), fan_out)]
        found.append(nodes)
    return found


def manifest_by_hand(rows, fan_out, tampered):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(r, more=0):
        n = None if r.n_chars is None else r.n_chars + more
        return sha(*map(field, (r.doc_id, r.source, r.lang, n, r.text)))

    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(((r.doc_id is not None, r.doc_id or 0, leaf(r)), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([k[2] for k, _ in sorted(groups[g], key=lambda x: x[0])], fan_out) for g in langs}
    top = tree([trees[g][-1][0] for g in langs], fan_out)
    out = []
    for at, g in enumerate(langs):
        for place, (key, r) in enumerate(sorted(groups[g], key=lambda x: x[0])):
            node, proof = leaf(r, tampered(r.doc_id)), []
            for levels, p in ((trees[g], place), (top, at)):
                for nodes in levels[:-1]:
                    start = p - p % fan_out
                    run = nodes[start : start + fan_out]
                    proof += run[: p - start] + run[p - start + 1 :]
                    run = [*run[: p - start], node, *run[p - start + 1 :]]
                    node, p = sha(*run), p // fan_out
            out.append((r.doc_id, key[2], trees[g][-1][0], top[-1][0], proof, node))
    return out


def is_tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


@pytest.mark.parametrize("fan_out, block", [(2, 2), (2, 16), (2, 1024), (3, 9)])
def test_merkle_manifest(docs, fan_out, block):
    n = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1)
    changed = {"n_chars": F.coalesce(n, F.col("n_chars"))}
    got = merkle_manifest(docs, changed, fan_out=fan_out, block=block)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded_root"]
    want = manifest_by_hand(docs.collect(), fan_out, is_tampered)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    if block == 2:
        assert any(is_tampered(w[0]) and w[3] != w[5] for w in want)


def test_merkle_of_few_rows(docs):
    assert merkle_manifest(docs.limit(0)).collect() == []
    (row,) = merkle_manifest(docs.filter("doc_id = 8")).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof == []
    with pytest.raises(ValueError):
        merkle_manifest(docs, fan_out=3, block=16)


def test_resumed_state_is_a_rehash():
    nodes = [sha(str(i)).encode() for i in range(7)]
    built = Subtree(nodes, 7, 9, 3)
    for place in range(7):
        other = sha("other").encode()
        again = Subtree([*nodes[:place], other, *nodes[place + 1 :]], 7, 9, 3)
        assert built.fold(place, other) == again.root
        assert built.fold(place, nodes[place]) == built.root


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest=1):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [
        " ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]


def resampled_by_hand(texts, target, percent, buckets, least, longest):
    def counts(many):
        found = [0] * buckets
        for t in many:
            for f in features(t, longest)[1]:
                found[zlib.crc32(f.encode()) % buckets] += 1
        return found

    s, t = counts(x for _, x in texts), counts(target)
    gains = [
        math.floor(1000 * math.log((t[i] + 1.0) * (sum(s) + buckets) / ((s[i] + 1.0) * (sum(t) + buckets))))
        for i in range(buckets)
    ]
    rows = []
    for doc_id, text in texts:
        words, runs = features(text, longest)
        weight = sum(gains[zlib.crc32(f.encode()) % buckets] for f in runs)
        name = "null" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(runs), weight, score, None, len(words) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = rank + 1
    return sorted(str(tuple(r[:5])) for r in rows)


TARGET = ["Shared WORDS, shared", None, "", "w1 w2-w3"]


@pytest.mark.parametrize("percent, longest", [(10, 1), (50, 2), (100, 3), (0, 1)])
def test_importance_resample(docs, spark, percent, longest):
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    got = importance_resample(docs, target, percent, 50, 3, longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = resampled_by_hand([(d, t) for d, t, _ in TEXTS], TARGET, percent, 50, 3, longest)
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_resampling_of_nothing(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance_resample(docs.limit(0), none).collect() == []
    got = importance_resample(docs, none, 10, 50, 3)
    want = resampled_by_hand([(d, t) for d, t, _ in TEXTS], [], 10, 50, 3, 1)
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_long_texts_are_read_in_spans(monkeypatch):
    monkeypatch.setattr(resample, "SPAN", 40)
    text = "Ab cd-ef gh1 ij " * 30 + "z" * 200 + " end"
    for longest in (1, 2, 3):
        got = sorted(n for part, _ in bucket_numbers(text.encode(), 1000, longest) for n in part.tolist())
        assert got == sorted(zlib.crc32(f.encode()) % 1000 for f in features(text, longest)[1])


def test_quickselect_finds_every_key(spark):
    # Scores tie in large groups, ids are repeated and null.
    rows = spark.range(300, numPartitions=5).selectExpr(
        "struct(id % 3 - 1 AS down, if(id % 7 = 0, null, id % 5) AS doc_id, id AS row) AS key"
    )
    want = sorted(
        (tuple(r.key) for r in rows.collect()), key=lambda k: (k[0], k[1] is not None, k[1] or 0, k[2])
    )
    for k in (1, 2, 150, 299, 300):
        found = rows.filter(F.col("key") == kth_key(Scratch(spark, "select"), rows, k, 3)).first()
        assert tuple(found.key) == want[k - 1]


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_importance_resampling"])
def test_query_matches_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, sf_dir).select(*expected.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected.fetchall()))


def test_pages_give_their_article(spark, sf_dir):
    """Another way to the same text: everything in <article>, cut at its blocks."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in queries.QUERIES["op13_html_extraction"](spark, sf_dir).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", r.html, re.DOTALL)[1]
        blocks = [
            " ".join(html.unescape(re.sub("</?b>", "", b)).split())
            for b in re.split("</?(?:p|h1|br)>", inside)
        ]
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want
        assert (got[r.page_id].url, got[r.page_id].n_chars) == (r.url, len(want))


PARA = "A long paragraph of the article that says quite a lot about its subject, in whole sentences."
SHAPES = {
    "boilerplate": (
        "<body class='has-sidebar'><div class='cookie-notice'>We use cookies to make this site better, "
        "and would like to know whether you accept them.</div><header><h2>The name of the site</h2></header>"
        "<nav><a href=/>Home</a></nav><main><article class='post has-comments'><header><h1>Title &amp; more"
        f"</h1></header><p>{PARA}</p><div class='advert'>Buy now! Buy now!</div><p>Short.</p><form><label>Mail"
        "</label><input></form><section><h2>Two</h2><p>x &lt; y&nbsp;z</p></section></article><section "
        "id='comments'><article class='comment'><p>I think that this is a great article, a very great one."
        f"</p></article></section></main><aside><p>{PARA}</p></aside><footer>c</footer></body>",
        ["Title & more", PARA, "Short.", "Two", "x < y z"],
    ),
    "no names": (
        "<div><a href=/>Home</a> | <a href=/b>About us</a></div><div><div><div><h1>Title</h1><div>"
        f"<p>{PARA}</p><p>tiny</p><p>{PARA}</p></div></div></div></div><div><div><div><div>(c) Corp</div>"
        "</div></div></div>",
        ["Title", PARA, "tiny", PARA],
    ),
    "article in a box named like something else": (
        f"<div class='widget search'><article><p>{PARA}</p></article></div><div>Other</div>",
        [PARA],
    ),
    "raw elements": (
        "<p>a</p><script>if (a<b) write('<p>no</p>')</script><style>p > a {x: '</p>'}</style>"
        "<!-- <p>no</p> --><p>b<br>c<textarea><p>d</textarea>",
        ["a", "b c"],
    ),
    "open elements": (
        f"<body><article><p>{PARA}<p>next<ul><li>one<li>two</ul><p title='a > b'>q</p><!-- open",
        [PARA, "next", "one", "two", "q"],
    ),
    "references": ("<p>1 < 2 &#38; &eacute;&#x20AC; <b>bo</b>ld &amp;lt;</p>", ["1 < 2 & é€ bold &lt;"]),
    "hidden": (f"<p>{PARA}</p><p hidden>no</p><div style='display: none'>no</div>", [PARA]),
    "no markup": ("just text\n over   lines", ["just text over lines"]),
    "only boilerplate": ("<nav><a href=/>Home</a></nav><footer>f</footer>", []),
    "empty": ("", []),
    "null": (None, []),
    "many blocks": ("<article>" + f"<p>{PARA}</p>" * 3000 + "</article>", [PARA] * 3000),
}


def test_page_shapes(spark):
    rows = [(i, None if i % 2 else "u", h, 1, 1) for i, (h, _) in enumerate(SHAPES.values())]
    rows += [rows[0], (None, None, "<p>x</p>", 1, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int, n_chars int")
    got = sorted(map(str, map(tuple, extract_text(pages).collect())))
    texts = {i: "\n".join(blocks) for i, (_, blocks) in enumerate(SHAPES.values())} | {None: "x"}
    assert got == sorted(str((p, u, texts[p], len(texts[p]))) for p, u, *_ in rows)
    assert extract_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize("piece", ["<p", "<a title=\"x>", "</b><span>", "<!-- ", "< a &", "<a ''"])
def test_odd_markup_takes_linear_time(piece):
    import time

    start = time.process_time()
    main_text(piece * 50_000)
    assert time.process_time() - start < 5


def test_text_runs():
    assert text_runs([0, 5, 0, 0, 5, 0, 0, 0, 9, 9, 0], 3) == [(1, 5, 5), (8, 10, 18)]
    assert text_runs([], 3) == [] and text_runs([0, 0], 3) == []
