"""Learned operators: held-out accuracy on small invented data."""

import random

from pyspark.sql import functions as F

from sluiceway.llm import language_id, quality_classifier, toxicity
from tests.llm.conftest import prose

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "re"], "bb": ["sch", "ung", "eit", "der", "zu"], "cc": ["ção", "ñe", "lla", "quo", "és"]}


def spoken(lang, seed, n=60):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randint(1, 4))) for _ in range(n))


def test_languages(spark):
    rows = [(i, spoken(lang, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs.where("doc_id % 4 <> 2"), sample=90)
    found = language_id.identify(docs.where("doc_id % 4 = 2"), model, F.struct("lang")).collect()
    assert all(r.row.lang == r.language and 0 <= r.score <= 1 for r in found)
    odd = spark.createDataFrame([(None,), ("",), ("12 34!",), ("zzzz wwww zzww " * 9,)], "text string")
    got = language_id.identify(odd, model, F.lit(1)).collect()
    assert [r.language for r in got][:3] == ["und"] * 3 and [r.score for r in got][:3] == [0.0] * 3
    assert got[3].language in SYLLABLES and got[3].rejected


def test_quality(spark):
    rows = []
    for i in range(240):
        good = i % 3 > 0
        rows.append((i, prose(i, 80) if good else (prose(i, 80).replace(" ", "## ") if i % 2 else f"{prose(i, 2)} " * 60), int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = quality_classifier.fit(docs, docs.where("doc_id % 5 > 0"))
    found = quality_classifier.score(docs.where("doc_id % 5 = 0"), model, F.struct("label")).collect()
    assert sum((r.score >= 0.3) == bool(r.row.label) for r in found) >= len(found) - 1
    alone = quality_classifier.fit(docs, docs.where("label = 1"))
    assert all(r.score > 0.9 for r in quality_classifier.score(docs, alone, F.lit(1)).collect())


def toxic_docs():
    rows = []
    for i in range(400):
        words = prose(1000 + i, 60).split()
        if i % 4 == 0:
            words[10] = random.Random(i).choice(["vilewort", "grobian", "schuftig"])
            words[30] = "murk" + random.Random(i + 1).choice(["al", "eb", "ic", "od", "um"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_toxicity(spark):
    docs = spark.createDataFrame(toxic_docs(), "doc_id long, text string, label int")
    lexicon = toxicity.fit(docs, docs.where("doc_id % 3 <> 1"))
    assert {"vilewort", "grobian", "schuftig"} <= set(lexicon.terms) and any(t.startswith("murk") and t.endswith("*") for t in lexicon.terms)
    found = toxicity.score(docs.where("doc_id % 3 = 1"), lexicon, F.struct("label")).collect()
    assert all((r.score >= 0.7) == bool(r.row.label) for r in found)
    clean = prose(5000, 60)
    probe = [clean, clean + " you vilewort", clean + " you vi1ewort", f'{clean} he said "vilewort" to them', "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(probe)], "i int, text string")
    score = {r.row.i: r.score for r in toxicity.score(rows, lexicon, F.struct("i")).collect()}
    assert score[1] > score[2] > score[0] and score[1] > score[3] and max(score[0], score[4], score[5]) < 0.7


def test_one_edit_is_found_and_two_are_not():
    trie = toxicity.Trie({"moron": 2.0, "scum": 1.0, "lowei*": 3.0})
    def edits(word):
        return (trie.met(word) or (None,))[0]

    assert [edits(w) for w in ("moron", "m0ron", "morn", "mooron", "m0r0n", "scum", "scun", "loweischaft")] == [0, 1, 1, 1, None, 0, None, 0]


def test_only_true_copies_count_once(spark):
    """Documents that share frequent words stay apart; copies, in any order of words, are one."""
    rows = []
    for i in range(240):
        common = prose(77, 40).split()
        own = prose(3000 + i, 6).split()
        rows.append((" ".join(common + own + (["rarebile"] if i < 12 else [])), int(i < 80)))
    rows += [(" ".join(common + ["copiedbile"]), 1), (" ".join(["copiedbile"] + common[::-1]), 1)] * 10
    sample = spark.createDataFrame(rows, "text string, label int")
    terms = toxicity._terms(sample)
    assert "rarebile" in terms and "copiedbile" not in terms
    assert toxicity._terms(sample.repartition(7)) == terms


def test_near_copies_add_no_term(spark):
    """Six near copies of three toxic texts, one word changed in each, teach nothing about the ordinary words of these texts."""
    rows = toxic_docs()
    docs = [(text, label) for _, text, label in rows]
    plain = toxicity._terms(spark.createDataFrame(docs, "text string, label int"))
    for i in (0, 4, 8):
        for k in range(6):
            words = rows[i][1].split()
            words[15 + 5 * k] = f"other{k}"
            docs.append((" ".join(words), 1))
    assert set(toxicity._terms(spark.createDataFrame(docs, "text string, label int"))) == set(plain)


def test_terms_need_proof(spark):
    """With as many toxic as clean texts, words that toxic ones have by chance do not enter."""
    rows = []
    for i in range(300):
        own = [random.Random(1000 * i + k).choice(prose(k, 400).split()) for k in range(20)]
        rows.append((" ".join([*prose(i + 1, 15).split(), *own, *(["vilewort"] if i % 2 and i < 60 else [])]), i % 2))
    terms = toxicity._terms(spark.createDataFrame(rows, "text string, label int"))
    assert "vilewort" in terms and len(terms) <= 3


def test_score_is_that_of_the_plain_model(spark, edge):
    """The registered query's values against a plain scoring with the same lexicon."""
    import math
    import re
    import zlib

    from sluiceway.llm.queries import corpus_queries

    trial = [(i, t, y, 0) for i, t, y in toxic_docs()]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in trial] + [(9000, None), (9001, ""), (None, "vilewort")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in trial], "doc_id long, toxic int")
    import tempfile

    folder = tempfile.mkdtemp(prefix="toxic-")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    learnt = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    lexicon = toxicity.fit(docs, learnt, label="toxic")

    def edits(word):
        found = []
        for term, weight in lexicon.terms.items():
            core, stem = term.removesuffix("*"), term.endswith("*")
            heads = {word[:n] for n in range(len(core) - 1, len(core) + 2)} if stem else {word}
            exact = word[: len(core)] == core if stem else word == core
            near = len(core) >= (6 if stem else 5) and any(_distance(h, core) <= 1 for h in heads)
            if exact or near:
                found.append((0 if exact else 1, -weight))
        return (min(found)[0], -min(x for x in found if x[0] == min(found)[0])[1]) if found else None

    def plain(text):
        words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
        counts = [0, 0]
        total = 0.0
        for w in words:
            hit = edits(w)
            if hit:
                counts[hit[0]] += 1
                total += hit[1] / (1 + hit[0])
        row = [*counts, 0, 100 * sum(counts) / max(len(words), 1), total]
        z = sum(math.log1p(x) * w for x, w in zip(row, lexicon.weights)) + lexicon.weights[5]
        return 1 / (1 + math.exp(-z))

    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in corpus_queries()["op8_toxicity"](spark, folder).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 3 == 1)
        assert abs(r.score - plain(texts[r.doc_id])) < 1e-9 and r.predicted == int(r.score >= 0.7)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_words_ruled_out_are_no_hits():
    """Every word that an unfiltered walk through the trie meets passes the tables before it, with letters of any size."""
    import pyarrow as pa

    from sluiceway.llm.text import Words, letter_words, lower_ascii

    pick = random.Random(5)
    letters = "abdeor1öéßдуракий­​中😀"
    terms = {"größer": 1.0, "trödler": 1.0, "brésil": 1.0, "crétin": 1.0, "дурак": 1.0, "moron": 1.0, "grobian": 1.0, "scum": 1.0, "böse*": 1.0, "дурако*": 1.0, "abc": 1.0}
    for _ in range(60):
        term = "".join(pick.choice(letters) for _ in range(pick.randint(3, 8)))
        terms[term + "*" * (len(term) > 3 and pick.random() < 0.3)] = 1.0
    words = ["großer", "trodler", "bresil", "cretin", "дорак", "mo­ron", "gr​obian", "ab", "дурнакой"]
    for term in terms:
        for _ in range(40):
            word, at = term.removesuffix("*"), pick.randrange(len(term))
            word = word[:at] + pick.choice(["", pick.choice(letters)]) + word[at + pick.randint(0, 1) :]
            words.append(word + "".join(pick.choice(letters) for _ in range(pick.choice([0, 0, 3]))))
    words = [w for w in words if w]
    lexicon = toxicity.Lexicon(terms)
    found = Words(pa.array([" ".join(words[:99]), None, "", " ".join(words[99:])]), letter_words(), lower_ascii())
    assert len(found) == len(words)
    likely = set(lexicon._likely(found).tolist())
    met = {i for i, w in enumerate(words) if lexicon.trie.met(w)}
    assert all(lexicon.may_meet(words[i]) for i in met)
    assert met <= likely and set(range(7)) <= met and len(met) > 1000
    assert lexicon._likely(Words(pa.array(["", None]), letter_words(), lower_ascii())).size == 0
    plain = Words(pa.array([prose(6, 4000)]), letter_words(), lower_ascii())
    assert len(lexicon._likely(plain)) < 400
