import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import components, decontaminate, divergence, minhash

FOLDER = "/root/testdata/sf0.01"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_groups(rows, size, threshold=80):
    """Smallest reachable id and set size of each id, by comparing through an index of shingles."""
    sets = {}
    for i, text in rows:
        w = words_of(text)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    index, parent = defaultdict(list), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sorted(sets.items()):
        for j, common in Counter(j for g in s for j in index[g]).items():
            if 100 * common >= threshold * (len(s) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            index[g].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def near_copies(seed=5):
    """Groups of edited copies, chains of copies of copies, exact copies, very short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for size in (5, 12, 40, 90, 150):
        for _ in range(6):
            base = [rng.choice(vocabulary) for _ in range(size)]
            texts.append(base)
            for _ in range(8):
                copy = list(rng.choice(texts[-3:]) if rng.random() < 0.5 else base)
                for _ in range(rng.randrange(0, max(2, size // 14))):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                texts.append(copy)
    texts += [["solo"], ["Solo"], ["x", "y"], ["x", "Y"], ["x", "z"]]
    rng.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_brute_force_on_planted_copies(spark, size):
    rows = near_copies()
    found = minhash.group(spark.createDataFrame(rows, "doc_id long, text string"), words=size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_groups(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_groups_equal_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = minhash.group(docs, words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_groups([(r.doc_id, r.text) for r in docs.collect()], 2)


def test_odd_rows_of_groups(spark):
    long = "very long text " * 20_000
    rows = [(5, None), (6, ""), (7, " \n"), (None, "a b c"), (3, "a b c"), (1, "a b c"), (3, "a b c"), (8, long), (2, long + "x"), (None, None)]
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, component_id int, kept boolean")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.group(docs, words=2).collect()), key=str)
    assert len(got) == len(rows)
    assert {g for g in got if g[0] in (5, 6, 7)} == {(5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True)}
    assert [g for g in got if g[0] in (1, 3)] == [(1, 2, 1, True), (3, 2, 1, False), (3, 2, 1, False)]
    assert all(g[3] for g in got if g[0] is None)
    kept = minhash.keep_one(docs, words=2)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [5, 6, 7, 1, None, 2, 8]))
    assert minhash.group(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays_whatever_is_repeated(spark):
    text, near = "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o q"
    rows = [(1, text), (1, text), (2, near), (2, near), (None, text), (None, "x y z"), (None, "X y z"), (None, "x y z"), (3, None), (3, None), (None, ""), (None, ""), (4, "u v"), (4, "s t")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, _mark int").repartition(5)
    kept = minhash.keep_one(docs, words=2)
    got = sorted((str(r.doc_id), (r.text or "").lower()) for r in kept.collect())
    assert kept.columns == docs.columns
    assert got[:-1] == [("1", text), ("3", ""), ("4", got[2][1]), ("None", ""), ("None", "")] and got[-1] == ("None", "x y z")


def test_leaks_without_an_id_go_too(spark):
    item = "what is the capital city of the large northern country called today"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"so {item} yes"), (None, "nothing to see in this one at all"), (None, None), (7, f"well {item}"), (7, "a clean text"), (8, "another clean text")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _mark string")
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(str, [(None, rows[1][1]), (None, None), (8, rows[5][1])]))


def test_every_pair_of_different_components_meets_in_a_cell(spark, monkeypatch):
    """A large component, middling ones and single names in one bucket; and a bucket of single names only."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    found = {i: 1 if i <= 20 else 21 if i <= 25 else i for i in range(1, 41)}
    rows = [(7, i, c) for i, c in found.items()] + [(8, i, i) for i in range(1, 8)]
    cells = defaultdict(set)
    for r in minhash._dealt(spark.createDataFrame(rows, "h long, name long, found long")).collect():
        cells[r.h, r.kind, r.low, r.high].add(r.name)
    met = {(h, a, b) for (h, *_), names in cells.items() for a in names for b in names if a < b}
    assert {(7, a, b) for a in found for b in found if a < b and found[a] != found[b]} <= met
    assert {(8, a, b) for a in range(1, 8) for b in range(a + 1, 8)} <= met
    assert max(map(len, cells.values())) < 16  # no cell grows with its bucket


def star_of_copies(copies=600, size=120, edits=5, at=0.5, seed=7):
    """Copies of one text, each edited at places of its own: near to the base, not to each other; the base has a middling id."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(size)]
    texts = []
    for k in range(copies):
        copy = list(base)
        for j, place in enumerate(rng.sample(range(1, size - 1, 2), edits)):
            copy[place] = f"e{k}x{j}"
        texts.append(" ".join(copy))
    texts.insert(int(copies * at), " ".join(base))
    return list(enumerate(texts))


def test_copies_of_a_base_with_a_middling_id_are_one_group(spark):
    rows = star_of_copies()
    expected = brute_groups(rows, 2)
    assert {g for _, g in expected.values()} == {0}
    found = minhash.group(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_pairs_of_a_large_bucket_are_decided_wherever_they_stand(spark):
    """Only 71 and 93 are near each other, among 100 names that share all bands; the signatures of all are alike."""
    texts = {i: f"t{i} u{i} v{i} q{i}" for i in range(1, 101)} | {71: "a b c d e f g h i j k", 93: "a b c d e f g h i j k l"}
    docs = spark.createDataFrame([*texts.items(), (71, texts[71])], "doc_id long, text string")
    names = spark.createDataFrame([(i, 10, [0] * minhash.WORDS, list(range(minhash.BANDS))) for i in texts], "doc_id long, n_shingles long, signature array<long>, bands array<long>")
    buckets = spark.createDataFrame([(h, i) for h in range(minhash.BANDS) for i in texts], "h long, name long")
    links = spark.createDataFrame([], "a long, b long")
    groups = {r.node: r.component for r in minhash.settle(buckets, links, names, docs, 2, 80).collect()}
    assert groups == {93: 71}


def test_estimate_is_close_to_the_similarity():
    import numpy as np

    sketcher, rng = minhash.Sketcher(2), np.random.default_rng(2)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 2**63, 1100).astype(np.uint64)
        a, b = np.unique(pool[:1000]), np.unique(pool[100:])
        lanes = [sketcher.minima(s) & np.uint64(3) for s in (a, b)]
        equal = (lanes[0] == lanes[1]).mean()
        errors.append((equal - 0.25) / 0.75 - 900 / 1100)
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < minhash.SLACK


def test_components_of_chains_and_stars(spark):
    chain = [(k + 1, k) for k in range(100, 160)] + [(k, 7) for k in range(300, 340)] + [(5, 5), (7, 300)]
    found = {r.node: r.component for r in components.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {found[k] for k in range(101, 161)} == {100} and {found[k] for k in range(300, 340)} == {7}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


ITEM = "A train leaves Boston with 120 crates of apples and after 45 minutes Maria unloads 120 of them near the old harbour."


def leaks(spark, docs, items=((1, ITEM),)):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}


def test_templates_meet_other_numbers_and_names(spark):
    again = ITEM.replace("120", "999").replace("Maria", "Otto").replace("Boston", "Denver").replace("45", "7")
    broken = ITEM.replace("with 120", "with 999")
    found = leaks(spark, [(1, "Intro words. " + ITEM + " More words."), (2, again), (3, broken), (4, "nothing of that kind is here at all, 120 times"), (5, None), (6, ""), (6, ITEM), (7, "pad " * 50_000 + ITEM)])
    assert set(found) == {(1, 1), (2, 1), (6, 1), (7, 1)}
    assert found[1, 1].same_slots and not found[2, 1].same_slots


def test_each_occurrence_is_judged_on_its_own(spark):
    twice = "the red train from the station leaves at 9 and the red train from the station leaves at 11"
    sheet = "if you add 3 apples to 4 pears in one big basket you get how many fruits"
    docs = [(1, f"{twice} today"), (2, f"{sheet}\n\n{sheet.replace('3', '5')}"), (3, f"{sheet.replace('3', '6')}\n{sheet.replace('4', '8')}"),
            (4, sheet.replace("3", "5").replace("4", "5")), (5, sheet), (5, sheet.replace("3", "7")), (6, ITEM.replace("with 120", "with 999"))]
    found = leaks(spark, docs, [(1, twice), (2, sheet), (3, ITEM)])
    assert set(found) == {(1, 1), (2, 2), (3, 2), (4, 2), (5, 2)}
    assert found[1, 1].same_slots and found[2, 2].same_slots and found[5, 2].same_slots and not found[3, 2].same_slots and not found[4, 2].same_slots


def test_items_without_windows_are_met_word_for_word(spark):
    items = [(1, "Convert 5 km to miles"), (2, "Add 3 and 4 and 5 and 6 and 7 and 8 and 9 and 10"), (3, "Who is Ada?"), (4, "Name the largest ocean on our planet")]
    docs = [(1, "please convert 5 km to miles for me"), (2, "now Add 3 and 4 and 5 and 6 and 7 and 8 and 9 and 10 then"), (3, "A quiz. Who is Ada? She wrote."),
            (4, "the man who is Ada to us"), (5, "then Name the largest ocean on our planet and go"), (6, "Convert 6 km to miles"), (7, "and Tell the largest ocean on our planet and go")]
    assert set(leaks(spark, docs, items)) == {(1, 1), (2, 2), (3, 3), (5, 4), (7, 4), (6, 1)}


def test_short_items_are_met_with_other_values_as_sentences(spark):
    items = [(1, "Convert 5 km to miles."), (2, "What is 12 times 13?"), (3, "Who is Ada?"), (4, "Add 3 and 4 and 3."), (5, "Is 5 + 5 = 10?")]
    docs = [(1, "A sheet. Convert 8 km to miles. Then rest."), (2, "Sums:\nWhat is 14 times 15?\nwrite it down"), (3, "A quiz. Who is Otto? He wrote."), (4, "please convert 8 km to miles for me"),
            (5, "Add 9 and 1 and 9."), (6, "Add 9 and 1 and 8."), (7, "What is 14 times 15, they asked"), (8, "What is 14 plus 15?"), (9, "What is 12 times 13?"), (10, None)]
    found = leaks(spark, docs, items)
    assert set(found) == {(1, 1), (2, 2), (5, 4), (9, 2)}
    assert found[9, 2].same_slots and not found[2, 2].same_slots
    assert (found[2, 2].first_word, found[2, 2].last_word, found[2, 2].n_windows) == (1, 5, 1)


def brute_short(text, items):
    """Items of a sentence each whose words, with numbers and names left open, fill a sentence of the text with one value each."""
    sentences = [s.split() for s in re.split(r"(?<=[.!?])\s+|\n", text) if s.strip()]
    bare = lambda w: w.strip(".,;:!?").lower()
    slot = lambda w, k: bare(w)[0].isdigit() or (k > 0 and w[0].isupper())
    for i, item in items:
        words = item.split()
        for s in sentences:
            if len(s) == len(words) and all(slot(a, k) == slot(b, k) and (slot(a, k) or bare(a) == bare(b)) for k, (a, b) in enumerate(zip(s, words))):
                values = {(bare(b), bare(a)) for k, (a, b) in enumerate(zip(s, words)) if slot(b, k)}
                if len(values) == len({y for y, _ in values}):
                    yield i


def test_short_items_equal_a_plain_search_of_sentences(spark):
    rng = random.Random(11)
    forms = ["What is {0} times {1}?", "Convert {0} boxes to {1} crates.", "Does {2} owe {3} exactly {0} coins?", "Give {0} plums and {0} pears to {2}."]
    fill = lambda f: f.format(rng.randrange(9), rng.randrange(9), *(rng.choice(["Ada", "Otto", "Mia"]) for _ in range(2)))
    items = [(k, fill(forms[k])) for k in range(4)]
    filler = ["the river runs slowly by.", "nothing is known here.", "What was that?", "we went home late."]
    docs = [(k, " ".join(rng.choice([fill(rng.choice(forms)), rng.choice(filler)]) if rng.random() < 0.3 else rng.choice(filler[:3]) for _ in range(6))) for k in range(120)]
    wanted = {(d, i) for d, text in docs for i in brute_short(text, items)}
    assert len(wanted) > 30 and set(leaks(spark, docs, items)) == wanted


def test_short_items_and_empty_tables(spark):
    assert set(leaks(spark, [(1, "so we sing a very short song today"), (2, "a very long song")], [(9, "a very short song"), (8, None), (7, "two words")])) == {(1, 9)}
    assert leaks(spark, []) == {} and leaks(spark, [(1, ITEM)], []) == {}


def test_leaks_equal_a_plain_search_of_passages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    plain = lambda t: [w.strip(".,;:!?").lower() for w in (t or "").split()]
    windows = defaultdict(set)
    for r in bench.collect():
        w = plain(r.text)
        for k in range(len(w) - 7):
            windows[tuple(w[k : k + 8])].add(r.item_id)
    wanted = set()
    for r in docs.collect():
        w = plain(r.text)
        wanted |= {(r.doc_id, i) for k in range(len(w) - 7) for i in windows.get(tuple(w[k : k + 8]), ())}
    assert wanted and {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == wanted
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len({d for d, _ in wanted})


def brute_rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    twice = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(twice), failed


def test_base_rules_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(-1, None), (-2, ""), (-3, " \n\n"), (-4, "a a a a"), (-5, "a b c\na b c\n a b c"), (-6, "x y " * 40_000), (-7, "É é ⅷ <>|\r\n\x0b"), (-7, "é"), (None, "x")]
    rows = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(*r, None) for r in odd], "doc_id long, text string, lang string"))
    got = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in divergence.judge(rows).collect()))
    assert got == sorted((str(r.doc_id), *brute_rules(r.text)) for r in rows.collect())


def test_histograms_keep_clean_texts_and_drop_symbols(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = divergence.judge(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(not r.kept for r in rows if r.quality == 0) >= 0.5 * sum(r.quality == 0 for r in rows)
    assert divergence.judge(docs.limit(0)).count() == 0
    alone = divergence.judge(docs.withColumn("lang", docs.lang.substr(9, 9)))  # no language is known
    assert alone.where("kept = base_failed").count() == 0


def test_distance_equals_the_definition(spark):
    import math

    p, q = [3, 0, 5, 2], [0.1, 0.2, 0.7, 0.0]
    df = divergence._shares(spark.createDataFrame([(p,), ([0, 0, 0, 0],)], "c array<long>"), "c")
    got = [r[0] for r in df.select(divergence.distance("c", q)).collect()]
    share = [x / 10 for x in p]
    middle = [(a + b) / 2 for a, b in zip(share, q)]
    half = lambda v: sum(a * math.log2(a / m) for a, m in zip(v, middle) if a)
    assert abs(got[0] - math.sqrt((half(share) + half(q)) / 2)) < 1e-9 and got[1] == 0
