"""Long, broken and hostile inputs: each ends in seconds, with the result that the docstrings state."""

import hashlib
import itertools
import random
import re
import time
from datetime import date, timedelta

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import (
    bpe, chosen_path, exact_dedup, fingerprints, language, line_dedup, merges, packing, pii, queries, texts, token_counts, urls)

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
KEY = "a key for tests"


def docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + extra)


def made(spark, *cases):
    begun = time.time()
    rows = pii.pseudonymise(docs(spark, list(enumerate(cases))), KEY).sort("doc_id").collect()
    assert time.time() - begun < 60
    return [r["text"] for r in rows]


# Pseudonyms.

def test_pseudonyms_of_endless_rows(spark):
    labels, fours, eights, digits, ats = "mail x@" + "a." * 500_000, "1111 " * 200_000, "8888 " * 200_000, "7" * 1_000_000, "@" * 1_000_000
    mails, dots = "a@b.cd " * 100_000, "1." * 500_000
    found = made(spark, labels, fours, eights, digits, ats, mails, dots, "x" * 1_000_000 + "@", "(" * 1_000_000 + "1")
    assert found[0] == labels and found[1] == fours and found[3] == digits and found[4] == ats and found[6] == dots
    # Every sixteen eights are a valid card.
    assert len(set(re.findall(r"\d{4} \d{4} \d{4} \d{4}", found[2]))) == 1 and "8888" not in found[2] and len(found[2]) == len(eights)
    assert set(found[5].split()) == {found[5].split()[0]} and found[5].count("@mail.invalid") == 100_000


def test_pseudonyms_need_a_key(spark):
    spark.conf.unset(pii.KEY_SETTING)
    with pytest.raises(ValueError):
        pii.pseudonymise(docs(spark, [(1, "a@b.cd")]))
    spark.conf.set(pii.KEY_SETTING, KEY)
    own = pii.pseudonymise(docs(spark, [(1, "a@b.cd")])).head()["text"]
    spark.conf.unset(pii.KEY_SETTING)
    assert own == made(spark, "a@b.cd")[0] != pii.pseudonymise(docs(spark, [(1, "a@b.cd")]), "another").head()["text"]


def moved(left, right, left_size, right_size, key, turns):
    """The permutation written down once more; turns backwards undo it."""
    for turn in turns:
        def step(size, other):
            return int(hashlib.sha256(f"{key}|{abs(turn)}|{size}|{other}".encode()).hexdigest()[:14], 16) * (1 if turn > 0 else -1)
        if turn % 2:
            left = (left + step(left_size, right)) % left_size
        else:
            right = (right + step(right_size, left)) % right_size
    return left, right


FORTH, BACK = range(1, 11), range(-10, 0)


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10


def plain(kind, text, turns):
    """The pseudonym of a valid value, or the value of a pseudonym, without Spark."""
    key = KEY + kind
    digits = re.sub(r"\D", "", text)
    if kind == "ip":
        a, b, c, d = map(int, text.split("."))
        left, right = moved(a * 256 + b, c * 256 + d, 65536, 65536, key, turns)
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    if kind == "date":
        day = (date.fromisoformat(text) - date(1700, 1, 1)).days
        left, right = moved(day // 5411, day % 5411, 27, 5411, key, turns)
        return str(date(1700, 1, 1) + timedelta(left * 5411 + right))
    if kind == "ssn":
        area, group, serial = map(int, text.split("-"))
        left, right = moved(area - 1 if area < 666 else area - 2, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, turns)
        return f"{left + 1 if left < 665 else left + 2:03}-{right // 9999 + 1:02}-{right % 9999 + 1:04}"
    if kind == "phone":
        area, line = int(digits[-10:-7]), int(digits[-7:])
        first, areas = (0, 200) if area < 200 else (200, 800)
        left, right = moved(area - first, line, areas, 10**7, key, turns)
        out = f"{digits[:-10]}{left + first:03}{right:07}"
    else:
        half = (len(digits) - 1) // 2
        rest = len(digits) - 1 - half
        left, right = moved(int(digits[:half]), int(digits[half:-1]), 10**half, 10**rest, key, turns)
        out = f"{left:0{half}}{right:0{rest}}"
        out += str(-luhn(out + "0") % 10)
    figures = iter(out)
    return "".join(next(figures) if c.isdigit() else c for c in text)


def test_pseudonyms_are_those_of_an_independent_permutation_and_can_be_undone(spark):
    draw = random.Random(7)

    def card(size):
        while True:
            body = "".join(draw.choice("0123456789") for _ in range(size - 1))
            # Of nineteen digits the first sixteen alone are no card.
            if size != 19 or luhn(body[:16]):
                return body + str(-luhn(body + "0") % 10)

    values = [(kind, make()) for _ in range(40) for kind, make in {
        "ip": lambda: ".".join(str(draw.randrange(256)) for _ in range(4)),
        "date": lambda: str(date(1700, 1, 1) + timedelta(draw.randrange(146_097))),
        "ssn": lambda: f"{draw.choice([1, 665, 667, 899, draw.randrange(1, 666)]):03}-{draw.randrange(1, 100):02}-{draw.randrange(1, 10_000):04}",
        "phone": lambda: f"+1 ({draw.randrange(1000):03}) {draw.randrange(1000):03}-{draw.randrange(10_000):04}",
        "card": lambda: draw.choice([card(draw.randrange(13, 20)), re.sub(r"(\d{4})(?=\d)", r"\1-", card(16)), re.sub(r"(\d{4})(?=\d)", r"\1 ", card(19))]),
    }.items()]
    found = made(spark, *(f"<{v}>" for _, v in values))
    for (kind, value), pseudonym in zip(values, found):
        assert pseudonym == f"<{plain(kind, value, FORTH)}>"
        assert plain(kind, pseudonym[1:-1], BACK) == value


def test_cards_in_long_rows_are_taken_from_the_left(spark):
    draw = random.Random(3)
    rows = [[f"{draw.randrange(10_000):04}" for _ in range(draw.randrange(4, 30))] for _ in range(60)]
    rows += [["8888"] * n for n in range(4, 14)]
    tails = [draw.choice(["", " " + f"{draw.randrange(1000):03}"]) for _ in rows]
    for row, tail, new in zip(rows, tails, made(spark, *(" ".join(r) + t for r, t in zip(rows, tails)))):
        out, at = [], 0
        while at < len(row):
            sixteen = " ".join(row[at:at + 4])
            if at + 4 <= len(row) and luhn(sixteen.replace(" ", "")) == 0:
                out.append(plain("card", sixteen, FORTH))
                at += 4
            elif at + 4 == len(row) and tail and luhn((sixteen + tail).replace(" ", "")) == 0:
                out.append(plain("card", sixteen + tail, FORTH))
                at, tail = at + 4, ""
            else:
                out.append(row[at])
                at += 1
        assert new == " ".join(out) + tail


# Tokens.

def test_a_word_of_a_million_letters_is_the_librarys():
    draw = random.Random(1)
    library, encoder = token_counts.load_tokenizer(WORDS), bpe.WordBpe(WORDS)
    for letters, size in (("acgt", 1_000_000), ("abcdefghijklmnopqrstuvwxyzé", 200_000), ("a", 300_000)):
        word = "".join(draw.choice(letters) for _ in range(size))
        begun = time.time()
        found = encoder.encode([word])[0]
        assert time.time() - begun < 90
        assert np.frombuffer(found, "<u4").tolist() == library.encode(word, add_special_tokens=False).ids
    assert packing.encode_texts([word], WORDS) == [found]


def test_merging_in_arrays_is_merging_one_by_one():
    encoder, draw = bpe.WordBpe(WORDS), random.Random(2)
    words = ["".join(draw.choice("etaoinshré日9.") for _ in range(draw.randrange(1, 70))) for _ in range(3000)] + ["e", "the", "日本"]
    symbols, sizes = encoder.characters(words)
    found, lengths = encoder.merges.merge_all(symbols, sizes)
    ends, starts = np.cumsum(lengths), np.cumsum(sizes)
    for i in range(len(words)):
        assert found[ends[i] - lengths[i]:ends[i]].tolist() == encoder.merges.merge(symbols[starts[i] - sizes[i]:starts[i]].tolist())
    nothing, none = encoder.merges.merge_all(symbols[:0], sizes[:0])
    assert len(nothing) == len(none) == 0


def test_ranks_of_colliding_pairs():
    pairs = [(i, j) for i in range(60) for j in range(50)]
    table = merges.Merges(pairs, list(range(len(pairs))))
    left, right = (np.array(c) for c in zip(*pairs))
    assert (table.rank_of(left, right) == np.arange(len(pairs))).all()
    assert (table.rank_of(left + 60, right) == merges.NEVER).all()


def test_pieces_that_are_forgotten_come_back(monkeypatch):
    draw = random.Random(5)
    chosen = [" ".join("".join(draw.choice("abcdé.,日") for _ in range(draw.randrange(1, 9))) for _ in range(200)) for _ in range(40)]
    library = token_counts.load_tokenizer(WORDS)
    wanted = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(chosen, add_special_tokens=False)]
    monkeypatch.setattr(packing, "BATCH_CHARS", 1500)
    store = packing.PieceIds(WORDS, 400)
    monkeypatch.setattr(packing, "_store", lambda path: store)
    assert packing.encode_texts(chosen + chosen, WORDS) == wanted + wanted
    assert len(store.rows) < 4000 and len(store.rows) == len(store.starts) == len(store.sizes) == len(store.used)


def test_long_text_of_another_script_is_cut_and_calls_are_balanced_by_bytes(monkeypatch):
    long = "天地人，日月。" * 20_000 + "a b🙂c d" * 1000
    parts = list(texts.segments(long, 1000))
    assert len(parts) > 100 and "".join(parts) == long and max(map(len, parts)) < 1100
    groups = list(texts.by_size(["日" * 100] * 50 + ["a" * 100] * 50, 1000))
    assert max(sum(map(texts.byte_size, g)) for g in groups) <= 1000 and [len(g) for g in groups[:2]] == [3, 3]
    library, data = token_counts.load_tokenizer(BYTES), long[:30_000] + long[-3000:]
    monkeypatch.setattr(token_counts, "BATCH_CHARS", 500)
    assert token_counts.count_tokens([data], BYTES) == [len(library.encode(data, add_special_tokens=False).ids)]
    monkeypatch.setattr(packing, "BATCH_CHARS", 500)
    monkeypatch.setattr(bpe, "BATCH_CHARS", 500)
    wanted = token_counts.load_tokenizer(WORDS).encode(data, add_special_tokens=False).ids
    assert np.frombuffer(packing.encode_texts([data], WORDS)[0], "<u4").tolist() == wanted
    assert np.frombuffer(bpe.WordBpe(WORDS).encode([data])[0], "<u4").tolist() == wanted


def test_memo_keeps_what_is_asked_for_again():
    memo, asked = texts.Memo(10), []

    def compute(keys):
        asked.extend(keys)
        return [k * k for k in keys]

    for turn in range(50):
        memo.fill({1, 2, 100 + turn}, compute)
        assert memo[1] == 1 and memo[100 + turn] == (100 + turn) ** 2
    assert asked.count(1) == asked.count(2) == 1 and len(memo) + len(memo.older) <= 10


# Packing.

def padding(rows):
    used = {}
    for r in rows:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 2048
    return 1 - sum(used.values()) / 2048 / len(used), len(used)


def test_short_texts_are_packed_without_padding(spark):
    draw = random.Random(0)
    short = [(i, " ".join(["hello"] * draw.randrange(0, 20))) for i in range(12_000)]
    rows = packing.pack_documents(docs(spark, short), WORDS).collect()
    assert padding(rows)[1] <= -(-sum(r["length"] for r in rows) // 2048) + 1
    half = [(i, "hello" if i % 2 else "") for i in range(4000)]
    assert padding(packing.pack_documents(docs(spark, half), WORDS).collect())[1] == 3
    same = [(None, "")] * 5000 + [(1, "hello")]
    assert padding(packing.pack_documents(docs(spark, same), WORDS).collect())[1] == 3


def test_padding_of_the_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert padding(packing.pack_documents(table, WORDS).collect())[0] < 0.01


def test_plans_place_every_piece_once():
    draw = np.random.default_rng(3)
    for sizes in (draw.integers(1, 20, 500), draw.integers(1, 2049, 400), draw.integers(250, 262, 300), draw.lognormal(5, 1, 2000).astype(int) % 2048 + 1):
        histogram = {}
        for size in map(packing.class_size, sizes.tolist()):
            histogram[size] = histogram.get(size, 0) + 1
        plan = packing.make_plan(histogram, 2048, packing.GAP, packing.SHORT, packing.UNIT)
        filled = {}
        for size, n in histogram.items():
            assert all(size - s < 8 and s <= size for s in sizes if packing.class_size(int(s)) == size)
            found = plan.sequences(np.full(n, size), np.arange(n))
            for at in found.tolist():
                filled[at] = filled.get(at, 0) + size
        assert max(filled.values()) <= 2048 and sum(filled.values()) == sum(k * v for k, v in histogram.items())
        assert plan.gap <= packing.GAP


def test_knapsack_in_blocks_is_the_best_multiset():
    draw = np.random.default_rng(1)
    for _ in range(40):
        sizes = np.unique(draw.integers(2, 12, 4))
        prices, room = draw.random(len(sizes)), int(draw.integers(1, 40))
        value, pattern = packing.best_pattern(sizes, prices, room)
        best = max(sum(n * p for n, p in zip(chosen, prices)) for chosen in itertools.product(*(range(room // s + 1) for s in sizes))
                   if sum(n * s for n, s in zip(chosen, sizes)) <= room)
        assert value == pytest.approx(best) == pytest.approx(pattern @ prices) and pattern @ sizes <= room


# URLs and lines.

def test_urls_of_a_megabyte(spark):
    model = urls.fit_url_model(urls.labelled_urls(spark))
    long = ["data://" + "A" * 1_000_000, "http://" + "a." * 300_000 + "net/x", "http://h/" + "x/" * 400_000, "http://" + "é" * 500_000]
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(long)], "page_id long, url string, _grams string, host int")
    begun = time.time()
    found = urls.judge_urls(pages, queries.URL_RULES, model).sort("page_id").collect()
    assert time.time() - begun < 60 and [r["rule"] for r in found] == [None, "net/", None, None]
    empty = pages.limit(0)
    assert urls.judge_urls(empty, queries.URL_RULES, model).collect() == []
    assert urls.judge_urls(pages.limit(2).unionByName(pages.limit(2)), queries.URL_RULES, model).count() == 4


def plain_lines(rows):
    seen, out = {}, {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at:at + 3])
            if window in seen:
                gone |= {at, at + 1, at + 2}
            seen.setdefault(window, (doc_id, at))
        out[doc_id] = ("\n".join(line for at, line in enumerate(lines) if at not in gone), len(lines), len(gone))
    return out


def test_a_hundred_thousand_repeated_runs_in_one_text(spark):
    run = "one\ntwo\nthree"
    rows = [(1, run), (2, "\n".join(f"{run}\nline {i}" for i in range(100_000))), (3, "a\nb\n" * 1000)]
    begun = time.time()
    found = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.drop_repeated_lines(docs(spark, rows)).collect()}
    assert time.time() - begun < 90
    assert found == plain_lines(rows)


# Fingerprints and near duplicates.

@pytest.mark.parametrize("nulls, repeats", [(0, 0), (1, 0), (3, 2)])
def test_fingerprints_keep_every_row_of_large_ids(spark, nulls, repeats):
    draw = np.random.default_rng(nulls)
    ids = sorted({int(i) for i in draw.integers(-2**63, 2**63 - 1, 150)} | set(range(2**53 + 1, 2**53 + 51)))
    rows = [(i, f"text number {i} " * 3) for i in ids] + [(None, f"none {k}") for k in range(nulls)] + [(ids[k], "again") for k in range(repeats)]
    found = fingerprints.document_fingerprints(docs(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in found if r["doc_id"] is not None) == sorted(i for i, _ in rows if i is not None)
    assert len(found) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    wanted = [hashlib.sha256(fingerprints.edited_text(a[1], b[1]).encode()).hexdigest() for a, b in zip(order, order[1:] + order[:1])]
    assert sorted(r["edited_sha256"] for r in found) == sorted(wanted)


def test_near_duplicates_without_ids(spark):
    draw = random.Random(4)
    rows = [(None, " ".join(f"w{draw.randrange(10**6)}" for _ in range(40))) for _ in range(4000)]
    rows += [(None, t + " more") for _, t in rows[:1500]] + [(None, rows[0][1])] * 500
    begun = time.time()
    found = chosen_path.near_duplicates(docs(spark, rows)).collect()
    assert time.time() - begun < 120 and len(found) == len(rows)
    sizes = sorted(r["class_size"] for r in found)
    assert sizes.count(2) == 2 * 1499 and sizes.count(502) == 502 and sizes.count(1) == 2500
    left = chosen_path.keep_one_of_each(docs(spark, rows)).count()
    assert left in (4000, 4000 + 500)


def test_links_of_the_documents_against_brute_force(spark):
    """Ids divisible by 100 against all rows of the 0.1 tables' first files: no link of the join is missing or too many."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()

    def shingles(text):
        words = re.findall(r"[^\W_]+", text.lower())
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())

    sets = {r["doc_id"]: shingles(r["text"]) for r in table}
    links = {r["doc_id"]: r["n_links"] for r in chosen_path.near_duplicates(docs(spark, [tuple(r) for r in table])).collect()}
    for one in (i for i in sets if i % 10 == 0):
        near = [o for o in sets if o != one and sets[one] and 5 * len(sets[one] & sets[o]) >= 4 * len(sets[one] | sets[o])]
        assert links[one] == len(near)


# Languages.

def test_thousands_of_languages_fit_a_bounded_model(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.md5(F.col("id").cast("string"))).alias("text"),
        F.concat(F.lit("lang"), (F.col("id") % 5000).cast("string")).alias("lang"))
    model = language.fit_language_model(rows)
    assert len(model.languages) <= language.LANGUAGES and len(model.landmarks) <= language.LANDMARKS
    assert language.predict_language(rows.limit(50), model).filter("lang_pred = 'und'").count() == 0


def test_scores_are_those_of_plain_kernel_ridge(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit_language_model(table)
    marks, sample = np.zeros(language.COLUMNS, np.uint8), language.learning_rows(table, 300, "doc_id", "text", "lang").collect()
    sample.sort(key=lambda r: (r["lang"], r["columns"]))
    bits = np.stack([np.unpackbits(np.frombuffer(r["columns"], np.uint8)) for r in sample]).astype(float)
    unit = bits / np.sqrt(bits.sum(axis=1, keepdims=True))
    labels = np.array([model.languages.index(r["lang"]) for r in sample])
    draw = np.random.default_rng(0)
    chosen = np.concatenate([draw.permutation(np.flatnonzero(labels == c))[:40] for c in range(len(model.languages))])
    kernel, among = unit @ unit[chosen].T, unit[chosen] @ unit[chosen].T
    weight = np.diag(len(sample) / len(model.languages) / np.bincount(labels)[labels])
    left = kernel.T @ weight @ kernel + language.RIDGE * len(sample) / len(chosen) * among + 1e-8 * np.eye(len(chosen))
    ridge = np.linalg.solve(left, kernel.T @ weight @ np.eye(len(model.languages))[labels])
    held = [r["text"] for r in table.collect()][:60]
    present = np.zeros((len(held), language.COLUMNS))
    for row, text in zip(present, held):
        row[language.gram_columns(text, marks)] = 1
    wanted = present / np.sqrt(present.sum(axis=1, keepdims=True)) @ unit[chosen].T @ ridge
    assert abs(model.scores(held) - wanted).max() < 1e-3 and abs(model.folded().scores(held) - wanted).max() < 1e-3
    assert (model.scores(held).argmax(axis=1) == wanted.argmax(axis=1)).all()


# Odd tables, through every operator and every stage.

CLASHING = "lang string, source string, n_chars long, _row_key string, _mark string, _dropped int, _before string, before int, mark string, _place int, _KEY int"


@pytest.fixture()
def clashing(spark):
    long = " ".join(f"word{i} and {i * i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, "Same text here, with some words in it."), (3, "Same text here, with some words in it."),
            (4, "same text here, with some words in it."), (None, "no id at all in this row of the table"), (None, "no id at all in this row of the table"),
            (5, long), (6, "1234 !!"), (7, "Das ist ein Satz über Äpfel, Birnen und viele andere Dinge."), (8, "x" * 200_000),
            (9, "call 854-555-8570 or mail a@b.cd, please, and then come back again")]
    return docs(spark, [(*r, "en" if i % 2 else "de", None, 5, "k", "m", 1, "b", 2, "mm", 3, 4) for i, r in enumerate(rows)], ", " + CLASHING)


def test_stages_take_odd_tables_and_clashing_names(spark, clashing):
    rows, plain_row = clashing, {tuple(r) for r in clashing.collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, rows, "")
        assert after.columns == clashing.columns and after.dtypes == clashing.dtypes
        kept = {tuple(r) for r in after.collect()}
        if name != "pii":
            assert kept <= plain_row
        else:
            assert all(k[5:] == (*clashing.first()[5:],) for k in kept) and not any("854-555" in (k[1] or "") for k in kept)
        assert function(spark, clashing.limit(0), "").collect() == []
        # Each stage is judged on the whole odd table too.
        assert function(spark, clashing, "").count() > 0
    packed = corpus_pipeline.pack(spark, clashing, "").collect()
    assert sum(r["start"] == 0 for r in packed) == clashing.count()


def test_exact_and_near_duplicates_keep_columns_of_their_own_names(spark, clashing):
    for function, gone in ((exact_dedup.drop_exact_duplicates, 1 + 1 + 1 + 1), (chosen_path.keep_one_of_each, None)):
        after = function(clashing)
        assert after.columns == clashing.columns
        assert {tuple(r)[5:] for r in after.collect()} == {tuple(r)[5:] for r in clashing.collect()}
        assert gone is None or after.count() == clashing.count() - gone


def test_a_third_of_all_rows_without_id_and_with_one_text(spark):
    rows = [(None, "Hot text")] * 1500 + [(i, f"text {i % 2000}") for i in range(3000)] + [(77, "again")] * 400 + [(i, "HOT TEXT") for i in (5, 9)]
    found = exact_dedup.exact_duplicates(docs(spark, rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and "isnull(heavy_size" in plan
    rows_of = found.collect()
    groups = {}
    for r in rows_of:
        groups.setdefault(r["text_sha256"], []).append(r)
    assert len(rows_of) == len(rows)
    for own in groups.values():
        ids = [r["doc_id"] for r in own if r["doc_id"] is not None]
        assert {r["group_size"] for r in own} == {len(own)} and sum(r["kept"] for r in own) == 1
        assert {r["keep_id"] for r in own} == {max(ids, default=None)}
        assert [r["doc_id"] for r in own if r["kept"]] == [max(ids, default=None)]
    assert exact_dedup.drop_exact_duplicates(docs(spark, rows)).count() == len(groups)
