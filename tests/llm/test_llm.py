"""The training-data operators against brute force, their SQL, and odd inputs."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from stationkit.llm import (
    classlm,
    decontamination,
    forest,
    langid,
    licenses,
    mixing,
    quality,
    quotations,
    separators,
    superminhash,
)
from stationkit.llm.components import components
from stationkit.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, a clashing extra column."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, None, "en", "a", 0, "x"), (2, "", "en", None, 0, None), (3, " \n\t ", None, "a", 3, None),
        (4, "one two", "en", "a", 7, None), (5, "One  TWO", "fr", "b", 8, None),
        (6, long, "en", "b", len(long), None), (7, long + " end", "en", None, None, None),
        (7, long + " end", "en", None, None, None), (None, "no number here", "en", "a", 14, None),
        (None, None, None, None, None, None), (8, "1234 !!! $$$", "en", "a", 12, None),
        (9, "single", "de", "c", 6, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", list(ORACLE))
def test_equals_sql(spark, name):
    got = oracle.actual(QUERIES[name](spark, FOLDER))
    assert got == oracle.expected(oracle.connect(FOLDER), ORACLE[name])


def fold(number, parts):
    return zlib.crc32(str(number).encode()) % parts


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "x bigint, y bigint")).collect()))
    assert got == dict.fromkeys(range(61), 0) | dict.fromkeys((100, 150, 200), 100)
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def sets_of(texts, width):
    out = {}
    for i, text in texts:
        w = (text or "").encode().lower().split()
        n = len(w) - width + 1
        out[i] = {tuple(w[j : j + width]) for j in range(n)} if n > 0 else {tuple(w)} - {()}
    return out


def brute_groups(sets, percent):
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, docs, width, percent):
    random = np.random.default_rng(1)
    base = [f"t{i}" for i in range(150)]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for k in range(300):  # loose copies on either side of the threshold, few of them the same
        words = list(base)
        for place in random.choice(150, k % 9, replace=False):
            words[place] = f"e{k}-{place}"
        rows.append((10_000 + k, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = sets_of(rows, width)
    groups = brute_groups(sets, percent)
    got = superminhash.near_duplicates(table, width, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), groups[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)


def test_signature_estimates_similarity():
    random = np.random.default_rng(3)
    a = random.integers(0, 2**63, 500, dtype=np.uint64)
    b = np.concatenate((a[:400], random.integers(0, 2**63, 100, dtype=np.uint64)))
    both = superminhash.superminhash(np.concatenate((a, b)), np.repeat([0, 1], 500), 2, 128)
    assert abs((both[0] == both[1]).mean() - 400 / 600) < 0.15
    few = superminhash.superminhash(a[:3], np.zeros(3, np.int64), 1, 128)
    assert few.max() < np.iinfo(np.uint64).max


def test_band_rows():
    assert superminhash.band_rows(0.85) == 5
    assert superminhash.band_rows(0.8) == 4


def test_near_duplicates_odd(spark, odd, none):
    got = superminhash.near_duplicates(odd, 3, 85).collect()
    assert len(got) == 12
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[3].kept
    assert by[5].component_id == 4 and by[7].component_id == 6
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert superminhash.near_duplicates(none).count() == 0
    kept = superminhash.keep_one(odd, 3, 85)
    assert kept.columns == odd.columns and kept.where("doc_id IN (5, 7)").count() == 0


def test_quality(spark, odd, none):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(fold(r.doc_id, 5) == 0 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    got = quality.quality_scores(odd, labels).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {None}
    assert quality.quality_scores(none, labels).count() == 0
    assert {r.score for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}


def test_forward_backward_equals_enumeration():
    random = np.random.default_rng(0)
    counts, steps = np.array([3, 1, 4]), random.normal(size=(2, 2))
    bad = random.normal(size=8)
    got, _ = quality.forward_backward(bad, counts, steps)
    first = 0
    for n in counts:
        weights = np.zeros(n)
        total = 0.0
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            s = sum(bad[first + i] * y[i] for i in range(n))
            s += sum(steps[y[i], y[i + 1]] for i in range(n - 1))
            total += math.exp(s)
            weights += math.exp(s) * np.array(y)
        assert np.allclose(got[first : first + n], weights / total)
        first += n


def test_mix_near_targets(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mixed_documents(docs).collect()
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        size[r.source] += r.size
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target)
    assert math.isclose(sum(target.values()), 1.5 * sum(size.values()))
    assert all(target[s] <= 2 * size[s] + 1e-6 for s in target)
    stream = mixing.mixed_stream(docs).agg(F.sum("words")).first()[0]
    assert stream == sum(taken.values())
    got = mixing.mixed_documents(odd).collect()
    assert len(got) == 12 and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mixed_documents(none).count() == 0


def test_class_model(spark, docs, odd, none):
    for table in (docs, odd):
        rows = table.select("doc_id", "text").collect()
        tokens = [(r.doc_id, [*(r.text or "").encode().lower().split(), None]) for r in rows]
        counts = Counter()
        for i, words in tokens:
            if i is not None and fold(i, 7) != 2:
                counts.update(words)
        n, v = sum(counts.values()), len(counts)
        want = sorted(
            (len(w), sum(counts[x] > 0 for x in w),
             round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
            for _, w in tokens
        )
        got = classlm.log_probabilities(table).collect()
        assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
        assert {r.train_tokens for r in got} == {n}
        assert all(r.score < 0 and r.perplexity >= 1 for r in got)
    assert classlm.log_probabilities(none).count() == 0


def test_rare_words_meet_their_counts_in_the_join(spark, docs, monkeypatch):
    want = {r.doc_id: r.base_score for r in classlm.log_probabilities(docs).collect()}
    monkeypatch.setattr(classlm, "HOT_WORDS", 300)
    got = {r.doc_id: r.base_score for r in classlm.log_probabilities(docs).collect()}
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_class_model_beats_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = classlm.log_probabilities(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"))
    model, base = r.first()
    assert model > base


def test_exchange_separates_languages():
    pairs = np.zeros((9, 9))
    pairs[1:5, 1:5] = 50
    pairs[5:9, 5:9] = 50
    pairs[0, 1:] = pairs[1:, 0] = 5
    of = classlm.exchange(pairs, classes=3)
    assert of[0] == 0 and len(set(of[1:5])) == len(set(of[5:9])) == 1 and of[1] != of[5]


def test_decontamination(spark, odd, none):
    words = [f"q{i}" for i in range(40)]
    item = " ".join(words)
    edited = list(words)
    for place in (5, 17, 29):
        edited[place] = "changed"
    edited.insert(22, "extra")
    other = " ".join(f"z{i}" for i in range(300))
    rows = [(1, f"{other} {item}, {other}"), (2, f"{other} {' '.join(edited)} {other}"), (3, other),
            (4, None), (5, ""), (None, item), (6, item.upper()), (7, f"{' '.join(words[:8])} {other}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame(
        [(9, item), (10, None), (11, ""), (None, item), (12, "y z")], "item_id bigint, text string"
    )
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, items).collect()}
    assert set(got) == {(1, 9), (2, 9), (6, 9)}
    assert (got[1, 9].score, got[1, 9].first_word, got[1, 9].last_word) == (1.0, 300, 339)
    assert 0.7 < got[2, 9].score < 1
    assert decontamination.keep_clean(docs, items).count() == 5
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0
    assert decontamination.contaminated(none, items).count() == 0
    assert decontamination.contaminated(odd, items).count() == 0


def test_alignment_equals_plain_smith_waterman():
    random = np.random.default_rng(5)
    for _ in range(20):
        item = random.integers(1, 5, 12).astype(np.uint64)
        row = random.integers(1, 5, 20).astype(np.uint64)
        table = np.zeros((13, 21))
        for i in range(12):
            for j in range(20):
                change = 2 if item[i] == row[j] else -1
                table[i + 1, j + 1] = max(
                    0, table[i, j] + change, table[i, j + 1] - 1, table[i + 1, j] - 1
                )
        assert decontamination.align(item, row[None, :])[0][0] == table.max()


def test_language(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    got = langid.languages(odd).collect()
    assert len(got) == 12
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 8)} == {"und"}
    assert langid.languages(none).count() == 0
    assert langid.keep_known(odd).columns == odd.columns


def test_pieces_equal_greedy_parse():
    text, word = b" banana bandana", b"bandanas"
    model = langid.build({"x": text})
    rest, pieces = b" " + word, 0
    while rest:
        n = max([k for k in range(1, len(rest) + 1) if rest[:k] in text], default=1)
        pieces += 1
        rest = rest[n:]
    assert langid.count_pieces(model, [word])[0][0, 0] == pieces


def greedy(text, rest):
    pieces = 0
    while rest:
        n = max([k for k in range(1, len(rest) + 1) if rest[:k] in text], default=1)
        pieces, rest = pieces + 1, rest[n:]
    return pieces


def test_pieces_cross_words():
    text = b" the cat sat on the mat and the dog sat by the cat"
    model = langid.build({"x": text, "y": b" le chat et le chien"})
    lines = [b"the cat sat", b"the dog  sat on the mat", b"cat the zebra's mat", b"le chat sat", b"", b"  "]
    pieces, letters = langid.count_pieces(model, lines)
    assert pieces[0, 0] == 1 and letters.tolist()[:2] == [9, 17]
    for line, own in zip(lines, pieces, strict=True):
        run = b" " + b" ".join(line.split()) if line.strip() else b""
        assert own.tolist() == [greedy(text, run), greedy(b" le chat et le chien", run)]


def test_long_texts_are_parsed_in_segments():
    random = np.random.default_rng(3)
    words = [b"cat", b"dog", b"the", b"sat", b"zebra"]
    text = b" " + b" ".join(words[k] for k in random.integers(0, 5, 60))
    model = langid.build({"x": text})
    long = b" ".join(words[k] for k in random.integers(0, 5, 5_000)) + b" " + b"q" * 3_000
    pieces = langid.count_pieces(model, [long])[0][0, 0]
    whole = greedy(text, b" " + long)
    assert whole <= pieces <= whole + (len(long) + 1) / (langid.SEGMENT - 6) + 1


def test_languages_of_long_documents_only(spark):
    """A label whose documents are all very long is learned and predicted."""
    random = np.random.default_rng(7)
    words = {"en": "the and of to in house water people time year", "fr": "le la et dans maison eau gens temps année où"}
    rows = []
    for i in range(80):
        lang = ("en", "fr")[i % 2]
        own = words[lang].split()
        rows.append((i, " ".join(own[k] for k in random.integers(0, 10, 40 if lang == "en" else 4_000)), lang))
    got = langid.languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert all(r.lang_pred == ("en", "fr")[r.doc_id % 2] for r in got)
    model = langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.languages == ["en", "fr"]


def test_excerpts_are_whole_characters_and_use_the_room():
    texts = ["é" * 500, "one two three four", "alpha beta gamma delta " * 50, "", "…"]
    cut = langid.shared_out(texts, 300)
    cut.decode("utf-8")
    assert 250 < len(cut) <= 300 and b"two three" in cut


def test_separator_scan(spark, docs, odd, none):
    lines = map(bytes.split, open(separators.VOCABULARY, "rb").read().splitlines())
    import base64

    encode = separators.encoder({base64.b64decode(a): int(b) for a, b in lines})
    for table in (docs, odd):
        want = sorted((str(r.doc_id), len(encode(r.text or ""))) for r in table.collect())
        got = separators.document_tokens(table).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want
    assert separators.document_tokens(none).count() == 0


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_stitching_across_blocks(spark, tmp_path, block):
    random = np.random.default_rng(block)
    ids = np.where(random.random(200) < 0.15, 9, random.integers(10, 50, 200)).astype("<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    parts = separators.file_blocks(spark, str(tmp_path), block)
    rows = separators.count_tokens(parts, separator=9).orderBy("place").collect()
    want = [len(p) for p in "".join("|" if i == 9 else "x" for i in ids).split("|")]
    assert [r.n_tokens for r in rows] == (want if want[-1] else want[:-1])


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Where is the tool?\nIt was here."), (1, 1, "assistant", "In the red box."),
        (1, 2, "user", "> in the  RED box.\nNot there."),
        (1, 3, "assistant", "> Not there.\n> > In the red box.\nThen the blue one."),
        (1, 4, "user", "> Where is the tool?\n> It was here.\nFound it."), (1, 5, "user", None),
        (2, 0, "user", "> unknown words\nHello."), (None, 1, "user", "x"), (2, 0, "user", "again"),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn, r.own_text): r for r in quotations.reply_ordered(table).collect()}
    assert len(got) == 9
    at = {k[:2]: r for k, r in got.items()}
    assert [at[1, t].reply_to for t in range(6)] == [None, 0, 1, 2, 0, 4]
    assert [at[1, t].depth for t in range(6)] == [0, 1, 2, 3, 1, 2]
    assert (at[1, 3].quoted, at[1, 3].linked, at[1, 3].own_text) == (2, 2, "Then the blue one.")
    assert (at[2, 0].quoted, at[2, 0].linked, at[None, 1].root) == (1, 0, None)
    assert quotations.reply_ordered(table.limit(0)).count() == 0


def replies(spark, rows):
    kind = "conv_id bigint, turn bigint, role string, text string, level int, hash int, row int"
    table = spark.createDataFrame([(c, t, "u", x, 0, 0, 0) for c, t, x in rows], kind)
    got = quotations.reply_ordered(table.repartition(3)).collect()
    assert len(got) == len(rows)
    return {(r.conv_id, r.turn): (r.reply_to, r.quoted, r.linked) for r in got}


def test_quotes_are_passages(spark):
    """Rewrapped and partial quotes, two levels, common phrases, a quote that nobody said."""
    first = "The pump at the north gate lost pressure on Monday evening\nand nobody noticed it until the alarm rang."
    second = "Yes I will look at the pump tomorrow morning before the shift begins."
    rows = [
        (1, 0, first), (1, 1, "Yes"), (1, 2, second),
        (1, 3, "> the pump at the north gate\n> lost pressure on Monday\n> evening and nobody noticed\nSince when?"),
        (1, 4, "> > The pump at the north gate lost\n> > pressure on Monday evening\n> Since when?\nSunday."),
        (1, 5, "> yes\nGood."),
        (1, 6, "> Yes I will look at the pump\n> tomorrow morning\n>\n> before the shift begins.\nThanks."),
        (1, 7, "> something entirely different that was never said here\nWhat?"),
        (2, 0, second), (2, 1, "> the pump at the north gate lost pressure\nAnother conversation."),
    ]
    got = replies(spark, rows)
    assert got[1, 3] == (0, 1, 1) and got[1, 4] == (3, 2, 2) and got[1, 5] == (1, 1, 1)
    assert got[1, 6] == (2, 2, 2) and got[1, 7] == (6, 1, 0) and got[2, 1] == (0, 1, 0)


def test_a_repeated_text_links_to_its_last_sayer(spark):
    """Very many equal messages and quotes of them in one conversation; a very long text."""
    text = "all sensors of the lower basin are working again"
    rows = [(1, t, f"> {text}\n{text}") for t in range(400)]
    long = " ".join(f"w{i}" for i in range(60_000))
    rows += [(2, 0, long), (2, 1, "x"), (2, 2, "\n".join("> " + long[i : i + 700] for i in range(0, 7_000, 700)) + "\nok")]
    got = replies(spark, rows)
    assert got[1, 0] == (None, 1, 0) and all(got[1, t] == (t - 1, 1, 1) for t in range(1, 400))
    assert got[2, 2] == (0, 1, 1)


def test_the_given_messages_in_quoting_form(spark):
    rows = [(1, t, " ".join(f"c{t}w{i}" for i in range(40))) for t in range(8)] + [(None, 1, "a b"), (1, 9, None), (3, 0, "")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string").withColumn("role", F.lit("u"))
    shown = quotations.with_quotes(table)
    assert shown.columns == table.columns and shown.count() == len(rows)
    got = {r.turn: r for r in quotations.reply_ordered(shown).where("conv_id = 1").collect()}
    texts = {r.turn: r.text for r in shown.where("conv_id = 1").collect()}
    quoting = [t for t in range(8) if texts[t].startswith(">")]
    assert quoting and any("\n> " in texts[t] and texts[t].startswith("> > ") for t in quoting)
    for t in quoting:
        of = int(re.search(r"^> c(\d)w", texts[t], re.M)[1])
        assert got[t].reply_to == of and got[t].linked == got[t].quoted > 0
    assert all(got[t].own_text == " ".join(f"c{t}w{i}" for i in range(40)) for t in range(8))
    assert quotations.with_quotes(table.limit(0)).count() == 0


def test_quotations_long_conversation(spark):
    table = spark.range(1000).selectExpr("1 AS conv_id", "id AS turn", "'u' AS role", "'hi' AS text")
    got = quotations.reply_ordered(table).collect()
    assert all(r.depth == r.turn and r.root == 0 for r in got)


def test_licenses(spark, odd, none):
    mit = licenses.TEMPLATES["mit"]
    cut = mit.replace("free of charge", "for free").replace("without restriction", "at will")
    rows = [(1, f"Hello there.\n{mit}\nEnd."), (2, cut), (3, "Nothing here at all to see."),
            (4, "x Released under the MIT License. y Released under the MIT license z"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = licenses.license_spans(docs).collect()
    assert sorted((r.doc_id, r.template) for r in got) == [
        (1, "mit"), (2, "mit"), (4, "mit-notice"), (4, "mit-notice")
    ]
    full = next(r for r in got if r.doc_id == 1)
    assert full.coverage == 1.0 and full.first_word == 2
    assert 0.8 < next(r for r in got if r.doc_id == 2).coverage < 1
    assert licenses.license_spans(odd).count() == licenses.license_spans(none).count() == 0


def test_winnow_common_runs_share_a_print():
    random = np.random.default_rng(2)
    run = random.integers(0, 2**62, 3).astype(np.uint64)
    for _ in range(30):
        a = np.concatenate((random.integers(0, 2**62, 9).astype(np.uint64), run))
        b = np.concatenate((run, random.integers(0, 2**62, 9).astype(np.uint64)))
        assert set(a[licenses.winnow(a)]) & set(b[licenses.winnow(b)])


def test_near_vectors(spark):
    random = np.random.default_rng(4)
    base = random.normal(size=(300, 16))
    near = base[:60] + 0.12 * random.normal(size=(60, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate((base, near, base[:5])))]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [math.nan] * 16), (None, [1.0] * 16),
           (904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, [2.0, 4.0])]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in forest.near_vectors(table).collect()}
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    links = m @ m.T >= 0.9
    np.fill_diagonal(links, False)
    found = sum(got[i].n_links for i in range(len(rows)))
    assert links.sum() >= found >= 0.9 * links.sum()
    assert all(got[i].n_links <= links[i].sum() for i in range(len(rows)))
    assert got[0].n_links >= 1 and not got[360].kept and got[360].component_id == 0
    assert all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 903, 904, None))
    assert got[906].component_id == 905 and got[905].n_links == 1
    assert forest.near_vectors(table.limit(0)).count() == 0


def test_crowded_leaves_are_split(spark, monkeypatch):
    monkeypatch.setattr(forest, "CROWDED", 40)
    monkeypatch.setattr(forest, "SAMPLE_VALUES", 64)
    random = np.random.default_rng(6)
    base = random.normal(size=(200, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate((base, base * 1.5)))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in forest.near_vectors(table, 0.999).collect()}
    assert all(got[i + 200].component_id == i for i in range(200))


def test_pipeline_keeps_columns(spark, docs):
    import corpus_pipeline

    table = docs.withColumn("extra", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, FOLDER)
        assert out.columns == table.columns and 0 < out.count() <= table.count()
    assert pa.__version__ and corpus_pipeline.STAGES[-1][1](spark, table, FOLDER).count() == 200


def test_pipeline_run_applies_its_stages_in_turn(spark, tmp_path):
    """Each stage on what the one before has kept; nothing comes back, and the last takes all that is left."""
    import corpus_pipeline

    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, rows, FOLDER).write.parquet(str(tmp_path / str(number)))
        rows = spark.read.parquet(str(tmp_path / str(number)))
        kept.append({r.doc_id for r in rows.select("doc_id").collect()})
    assert all(after <= before for before, after in zip(kept, kept[1:], strict=False))
    assert kept[-1] == kept[-2] and len(kept[2]) < len(kept[1])
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, rows.collect()))
