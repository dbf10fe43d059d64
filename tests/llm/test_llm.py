"""The corpus operators on small tables with every awkward shape, against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle_check import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import packing, queries
from orderloom.llm.chat_format import chat_format
from orderloom.llm.exact_dedup import exact_dedup
from orderloom.llm.language_id import language_id, learn_profiles, predict_languages
from orderloom.llm import line_dedup as line_dedup_module
from orderloom.llm.line_dedup import line_dedup
from orderloom.llm.mixing import draw_copies, fit_domains, fit_rates, mix_sources
from orderloom.llm.ngram_join import Probes, Trie, ngram_components
from orderloom.llm import quality_classifier as quality
from orderloom.llm.quality_classifier import classify_quality
from orderloom.llm.quality_rules import quality_rules
from orderloom.llm.substring_dedup import substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def prose(seed, n, vocabulary=4000):
    random = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in random.integers(0, vocabulary, n))


BASE = prose(1, 120)
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE + " tail"), (4, None), (5, ""), (6, "   \n\t"),
    (7, "one"), (8, "one"), (9, prose(2, 30) + " " + " ".join(BASE.split()[40:80]) + " " + prose(3, 30)),
    (10, prose(4, 25000)), (None, BASE), (None, "lost"), (12, "a b c d"), (12, "a b c d"),
    (13, "same line here today\nother line of text\nsame line here today"),
    (14, "xé éx 　 wide"), (15, " ".join(["again and"] * 80)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", "s", 0 if t is None else len(t)) for d, t in TEXTS]
    # Extra columns with names that the operators use inside.
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({n: F.lit(1) for n in ("token", "c", "mark", "rate", "label", "words")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_exact_dedup(docs):
    got = sorted((tuple(r) for r in exact_dedup(docs, 64).collect()), key=str)
    groups = {}
    for d, t in TEXTS:
        groups.setdefault(t or "", []).append(d)
    assert len(got) == len(TEXTS)
    for text, ids in groups.items():
        rows = [r for r in got if r[4] == hashlib.sha256(text.encode()).hexdigest()]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted(map(str, ids)) == sorted(str(r[0]) for r in rows)
        assert {r[1] for r in rows} == {keep} and {r[2] for r in rows} == {len(ids)}
        assert sum(r[3] for r in rows) == 1


def test_exact_dedup_tells_long_texts_apart(spark):
    long = "q" * 1000
    rows = [(1, long), (2, long), (3, long[:-1] + "z"), (4, long + "q"), (5, "z" + long[1:])]
    got = {r[0]: r[2] for r in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 1, 5: 1}


def test_substring_dedup(docs):
    rows = sorted(TEXTS, key=lambda r: (r[0] is None, r[0] or 0))
    seen, want = {}, []
    for d, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - 19):
            first = seen.setdefault(tuple(w[i : i + 20]), (d, i))
            if first != (d, i):
                gone.update(range(i, i + 20))
        kept = [x for i, x in enumerate(w) if i not in gone]
        want.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in substring_dedup(docs).collect())


def test_ngram_components(docs):
    def shingles(text):
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    rows = [(d, shingles(t)) for d, t in TEXTS]
    got = sorted(str(tuple(r)) for r in ngram_components(docs).collect())
    label = list(range(len(rows)))
    for _ in rows:
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    want = []
    for i, (d, s) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        want.append(str((d, len(s), min(ids, default=None) if s else d)))
    assert got == sorted(want)


def test_near_copies_chain(spark):
    base = prose(9, 300)
    rows = []
    for k in range(60):
        w = base.split()
        w[5 * k % 290] = f"changed{k}"
        w[(37 * k + 11) % 290] = f"other{k}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, " ".join(base.split()[:60]) + " " + prose(100 + k, 200)) for k in range(40)]
    got = {r[0]: r[2] for r in ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[k] for k in range(60)} == {0}
    assert all(got[100 + k] == 100 + k for k in range(40))


def test_trie_against_all_pairs():
    random = np.random.default_rng(3)
    base = np.unique(random.integers(0, 500, 60))
    sets = [np.unique(np.concatenate([random.choice(base, 40, replace=False), random.integers(0, 500, k % 12)])) for k in range(80)]
    trie = Trie()
    for k, s in enumerate(sets):
        trie.insert(k, s)
    together = {(k, int(i)) for k, hit in trie.linked(Probes(sets)) for i in hit}
    for i, probe in enumerate(sets):
        want = {k for k, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 80 * len(np.union1d(s, probe))}
        assert {k for k, _ in trie.linked(Probes([probe]))} == want
        assert {k for k, j in together if j == i} == want


def test_quality_rules(docs):
    for r in quality_rules(docs).collect():
        options = [t for d, t in TEXTS if d == r["doc_id"]]
        measured = []
        for text in options:
            w = words(text)
            starts = {}
            for i in range(len(w) - 2):
                starts.setdefault(tuple(w[i : i + 3]), []).append(i)
            repeats = {i + k for at in starts.values() if len(at) > 1 for i in at for k in range(3)}
            lines = [x for x in (text or "").split("\n") if words(x)]
            measured.append((
                len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
                len(lines) - len(set(lines)), len(repeats),
                len(w) < 50 or 100 * len(repeats) > 50 * len(w),
            ))
        assert tuple(r)[1:7] in measured
        assert not (r["base_failed"] and r["kept"])


def test_chat_format(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"),
        (3, 1, "assistant", "yes"), (4, 0, None, None), (5, 0, "user", None), (5, 0, "user", None),
        (None, 0, "user", "alone"),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(9))
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"], r["chat"]) for r in chat_format(frame).collect()}
    assert set(got) == {1, 4, 5, None}
    assert got[1] == (2, 2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n")
    assert got[4][2] == "<|im_start|>unknown\n<|im_end|>\n" and got[5][0] == 1


def test_packing_round_trip(docs):
    rows = packing.pack_documents(docs, queries.tokenizer_path(), open_bins=2, fan_in=2).collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    want = []
    for d, text in TEXTS:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, (start, n) in enumerate(packing.cut(len(ids), 2048)):
            raw = np.asarray(ids[start : start + n], dtype="<u4").tobytes()
            want.append((d, piece, start, n, zlib.crc32(raw)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in rows)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in bins.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 2 + -(-sum(n for *_, n, _ in want) // 2048)


def test_token_units_match_the_tokenizer():
    coder = packing.encoder(queries.tokenizer_path(), 0)
    texts = ["", None, "a", " a", "a ", "a  b", "it's 12 a.b,\nC d", "x \n y", "a <|endoftext|> b", "é 　 x", "a\tb c", "a  b"]
    for text, got in zip(texts, coder.encode(pa.array(texts))):
        want = coder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert got == np.asarray(want, dtype="<u4").tobytes(), text


def test_line_dedup(spark, docs):
    long = "the quick brown fox jumps over the lazy dog near the wide river bank"
    rows = [(1, f"{long}\n\nkeep me please, I am alone"), (2, f"{long}!\n{long}\nshort\n"), (3, "short"), (4, None), (None, long)]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (3, 0, rows[0][1])
    assert got[2] == (4, 2, "short\n")
    assert got[3][:2] == (1, 1) and got[4][:2] == (1, 0) and got[None][:2] == (1, 1)
    assert line_dedup(docs).count() == len(TEXTS)


def test_mixing_reaches_targets(spark):
    rows = [(i, " ".join(f"{'ab'[i % 4 == 0]}{j}" for j in np.random.default_rng(i).integers(0, 50, 40)), "xy"[i % 4 == 0]) for i in range(200)]
    frame = spark.createDataFrame([*rows, (900, None, None), (901, "", "x")], "doc_id long, text string, domain string")
    mixed = mix_sources(frame, frame, {"x": 0.5, "y": 0.5})
    got = mixed.select("doc_id", "mix.tokens", "mix.p", "mix.rate").collect()
    totals = np.sum([r["rate"] * r["tokens"] * np.array(r["p"]) for r in got], axis=0)
    assert totals[0] == pytest.approx(totals[1], rel=0.01) and min(r["rate"] for r in got) >= 0
    assert draw_copies(mixed).columns == frame.columns
    assert draw_copies(mixed).select("doc_id").distinct().count() >= 200


def test_language_and_quality_held_out(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    said = predict_languages(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert said.filter("lang = lang_pred").count() >= 0.95 * said.count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = classify_quality(table, labels).join(labels, "doc_id").filter("held_out")
    assert scored.filter("predicted = quality").count() >= 0.95 * scored.count()


def test_quality_learns_from_every_label(spark):
    n = 30_000
    texts = [f"{'x' * (i % 7)}{i} {i * i}" for i in range(n)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    good = np.array([i % 10 > 0 or i % 3 == 0 for i in range(n)])
    labels = spark.createDataFrame([(i, int(q)) for i, q in enumerate(good)], "doc_id long, quality int")
    ranking = quality.learn_ranking(table, labels)
    x = quality.features(pa.array(texts)).astype(np.float32).astype(float)
    assert np.allclose(ranking.mean, x.mean(axis=0), rtol=1e-9, atol=1e-12)
    assert np.allclose(ranking.scale, np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0))
    raw = ranking.raw(x)
    assert ranking.at_cut == pytest.approx(np.quantile(raw, 1 - good.mean()), abs=1e-9)
    assert raw[good].mean() > raw[~good].mean()


def test_every_group_of_pairs_has_both_labels(spark):
    rows = [(i, int(i != 7), f"text {i}".encode(), 1) for i in range(10_000)]
    labelled = spark.createDataFrame(rows, "mark long, quality int, x binary, w long")
    groups = quality._groups(labelled, 9_999, 1).collect()
    assert len(groups) == 3 and all(len(r["bads"]) == 1 for r in groups)
    assert sorted(g["x"] for r in groups for g in r["goods"]) == sorted(r[2] for r in rows if r[1])


def test_rank_of_repeated_values(spark):
    values = [(1.0, 3), (1.0, 2), (2.5, 4), (-7.0, 1), (1e9, 2)]
    scores = spark.createDataFrame(values, "raw double, w long")
    whole = np.repeat(*map(np.array, zip(*values)))
    for share in (0.0, 0.3, 0.5, 0.87, 1.0):
        assert quality._quantile(scores, share, len(whole)) == pytest.approx(np.quantile(whole, share))


def test_language_of_odd_texts(docs):
    languages, profiles = learn_profiles(docs)
    got = {r["doc_id"]: r for r in language_id(docs, languages, profiles).collect()}
    assert got[4]["lang_pred"] == got[5]["lang_pred"] == got[6]["lang_pred"] == "und"
    assert got[1]["lang_pred"] == "en"


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    talks = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for frame in (
        exact_dedup(empty), substring_dedup(empty), ngram_components(empty), quality_rules(empty),
        line_dedup(empty), packing.pack_documents(empty, queries.tokenizer_path()), chat_format(talks),
        classify_quality(empty, labels), predict_languages(empty),
        mix_sources(empty, empty.select("doc_id", "text", F.col("lang").alias("domain")), into="m"),
    ):
        assert frame.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    assert difference(spark, con, name, queries.QUERIES[name], queries.ORACLE[name], sf_dir) is None


def test_pipeline_stages(spark, docs, sf_dir):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).count() > 0


def soft_texts(n, seed=7):
    """Texts of a large and a small domain that share most of their words."""
    random = np.random.default_rng(seed)
    small = random.random(n) < 0.2
    return [
        (i, " ".join(f"w{j}" for j in random.normal(12 if s else 0, 12, 30).astype(int)), "de" if s else "en")
        for i, s in enumerate(small)
    ]


def test_mixing_stage_keeps_every_document(spark, tmp_path):
    frame = spark.createDataFrame(soft_texts(2000), "doc_id long, text string, lang string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    mixed = corpus_pipeline.mixing_stage(spark, frame, str(tmp_path))
    assert mixed.select("doc_id").distinct().count() == 2000
    labelled = frame.withColumnRenamed("lang", "domain")
    got = mix_sources(frame, labelled).select("mix.tokens", "mix.p", "mix.rate").collect()
    totals, own = (np.sum([w * r["tokens"] * np.array(r["p"]) for r in got for w in [r["rate"] if fitted else 1]], axis=0) for fitted in (True, False))
    wanted = (own / own.sum()) ** 0.7
    assert min(r["rate"] for r in got) >= 1
    assert totals / totals.sum() == pytest.approx(wanted / wanted.sum(), rel=0.01)


def test_near_stage_with_null_and_repeated_ids(spark, sf_dir):
    a, b, c, d = (prose(seed, 100) for seed in (31, 32, 33, 34))
    rows = [
        (None, a), (None, a + " tail"), (None, "head " + a), (None, b), (1, b + " tail"), (2, c),
        (7, c + " tail"), (7, d), (7, d + " tail"), (7, d + " tail"), (8, d), (None, ""), (None, None), (9, " "),
    ]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string")
    kept = corpus_pipeline.near_stage(spark, frame, sf_dir)
    assert kept.columns == frame.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "").split()[1:3]) for r in kept.collect())
    first = [(str(i), t.split()[1:3]) for i, t in ((1, b), (2, c), (7, d))]
    assert got[:3] == first and [i for i, _ in got[3:]] == ["9", "None", "None", "None"]


def test_mixing_small_and_rare_domains(spark):
    members = spark.createDataFrame([(10**9, [1.0, 0.0]), (3 * 10**4, [0.0, 1.0])], "tokens long, p array<double>")
    fit = fit_rates(members)
    assert [s[1] for s in fit.steps] == [pytest.approx(1 - (10**9 / (3 * 10**4)) ** 0.3, rel=0.01)]

    rows = [(None if i % 3 else i, f"w{i % 50} v{i % 7} u{i % 11}", "big") for i in range(3000)]
    labelled = spark.createDataFrame([*rows, (3000, "rare words", "small"), (3001, "", "mute")], "doc_id long, text string, domain string")
    domains, log_words = fit_domains(labelled, 50)
    assert domains == ["big", "small"]
    # A hash of rows without doc_id picks some of them, not all or none.
    assert 0.2 < np.exp(log_words[0]).max() * 8192.5 < 100
    with pytest.raises(ValueError, match="mute"):
        mix_sources(labelled, labelled, {"big": 1.0, "mute": 1.0})


def test_mixing_reports_missed_targets(spark):
    frame = spark.createDataFrame(soft_texts(500), "doc_id long, text string, domain string")
    with pytest.warns(UserWarning, match="de: .* of .*"):
        mix_sources(frame, frame, {"de": 0.999, "en": 0.001})


def test_line_shingles_and_bands():
    """Shingles of a batch are those of its lines, whatever lies around them; short lines have none."""
    texts = ["abcdefgh", "short", "", "aaaaaaaaaaaa", "é" * 6, "abcdefghi" * 40]
    lines = pa.array(["before it", *texts, "behind it"]).slice(1, len(texts))
    hashes, bounds = line_dedup_module._shingles(lines)
    tokens, edges = line_dedup_module._tokens(hashes, bounds)
    for i, text in enumerate(texts):
        raw = text.encode()
        grams = {raw[j : j + 8] for j in range(len(raw) - 7)}
        values = np.array([int.from_bytes(g, "little") for g in grams], dtype=np.uint64)
        mine = hashes[bounds[i] : bounds[i + 1]]
        assert mine.tolist() == sorted(line_dedup_module.mix(values).tolist())
        assert edges[i + 1] - edges[i] == len({h >> 60 for h in mine.tolist()})
    alone = line_dedup_module._tokens(*line_dedup_module._shingles(pa.array(texts[-1:])))[0]
    assert alone.tolist() == tokens[edges[-2] :].tolist()


def test_line_verification_is_exact():
    base = "the quick brown fox jumps over the lazy dog near the river"
    pairs = [(base, base + "!"), (base, base[:40]), ("short", "shirt"), (base, base.upper()), (base, base[5:] + "x")]
    batch = pa.RecordBatch.from_pydict(
        {"a": list(range(5)), "b": list(range(5)), "line": [p[0] for p in pairs], "other": [p[1] for p in pairs]}
    )

    def near(one, two):
        one, two = ({t[j : j + 8] for j in range(len(t) - 7)} for t in (one, two))
        return bool(one & two) and 100 * len(one & two) >= 80 * len(one | two)

    (got,) = line_dedup_module._alike(iter([batch]))
    assert got["a"].to_pylist() == [i for i, p in enumerate(pairs) if near(*p)]


def test_line_sketches_spare_verification(spark, monkeypatch):
    """Lines that share half their text but are not alike are not verified in pairs; near copies all go."""
    draw = np.random.default_rng(5)

    def words(n):
        return " ".join("".join(map(chr, draw.integers(97, 123, 6))) for _ in range(n))

    shared = words(25)
    lines = [f"{shared} {words(25)}" for _ in range(120)]
    copies = [line[:-2] + "zz" for line in lines[:40]]
    rows, stored, store = list(enumerate(lines + copies)), [], line_dedup_module.Scratch.store

    def counted(self, name, frame):
        table = store(self, name, frame)
        if "pairs" in name:
            stored.append(table.count())
        return table

    monkeypatch.setattr(line_dedup_module.Scratch, "store", counted)
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {doc for doc, gone in got.items() if gone} == set(range(120, 160))
    assert stored and sum(stored) < 3 * len(rows)
