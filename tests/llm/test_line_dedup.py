"""Line dedup on rows without an id and with a shared id."""

from sluiceway.llm import line_dedup
from tests.llm.conftest import prose


def opening(seed):
    return prose(seed, 240)


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return [(r.row.doc_id, r.row.text, r.kept, r.n_removed) for r in line_dedup.dedup(docs).collect()]


def test_rows_without_an_id(spark):
    """What repeats only among them goes but once, and nothing is cut from a text that repeats nothing."""
    shared, own = opening(31), opening(32)
    rows = [(None, shared + "\nfirst end"), (None, shared + "\nother end"), (None, own)]
    got = {text: (out, n) for _, text, out, n in kept(spark, rows)}
    assert got[own] == (own, 0)
    cut = [n for text, (_, n) in got.items() if text != own]
    assert min(cut) == 0 and max(cut) > 2


def test_a_copy_without_an_id_cuts_no_other_row(spark):
    """Chunks begin at the same lines in a text that repeats nothing; it stays whole."""
    shared = opening(31)
    mark = [line + " x" for line in shared.split("\n")]
    twins = []
    for seed in range(40):
        twins.append("\n".join(f"{line} {seed}" for line in mark))
    rows = [(1, shared), (None, shared + "\nmore")] + [(None, t) for t in twins]
    got = kept(spark, rows)
    assert all(out == text for i, text, out, _ in got if i == 1 or text in twins)
    assert [n > 2 for _, text, _, n in got if text == shared + "\nmore"] == [True]


def test_rows_of_one_id_and_other_texts(spark):
    shared = opening(31)
    twins = ["\n".join(f"{line} {seed}" for line in shared.split("\n")) for seed in range(40)]
    rows = [(1, shared), (2, shared + "\nmore")] + [(2, t) for t in twins]
    assert all(out == text for _, text, out, _ in kept(spark, rows) if text in twins)
    again = {text: n for _, text, _, n in kept(spark, [(5, shared + "\na"), (5, shared + "\nb")])}
    assert sorted(n > 2 for n in again.values()) == [False, True]


def shared_runs(texts, least=2):
    """Lines with a word of each text that lie in a run of `least` such lines that occurs elsewhere or before, by text."""
    wordy = [[(i, x) for i, x in enumerate(t.split("\n")) if x.strip(" \t\n\v\f\r")] for t in texts]
    places = {}
    for d, lines in enumerate(wordy):
        for k in range(len(lines) - least + 1):
            places.setdefault(tuple(x for _, x in lines[k : k + least]), []).append((d, k))
    later = set()
    for found in places.values():
        d, first = found[0]
        later |= {(e, wordy[e][k + j][0]) for e, k in found[1:] for j in range(least) if (e, k) >= (d, first + least) or e != d}
    return later


def test_pipeline_removes_every_repeated_run(spark):
    """Recall against all repeated runs of two lines or more, at any place and of any length; all else stays."""
    lines = prose(41, 12 * 60).split("\n")
    texts = ["\n".join(lines)]
    for n in range(2, 10):
        for at in range(0, 60 - n, 7):
            texts.append(f"{prose(1000 * n + at, 40)}\n" + "\n".join(lines[at : at + n]) + f"\n{prose(9000 + 100 * n + at, 30)}")
    texts += ["same line\n" * 7, "a b\n\n c d\ne f\n a b", "x y\na b\n\n c d\nz", lines[3], "", " \n\n"]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[5]), (None, None)], "doc_id long, text string")
    later = shared_runs([*texts, texts[5]])
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated(docs).where("doc_id IS NOT NULL").collect()}
    wanted = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in later) for d, t in enumerate(texts)}
    blank = len(texts) - 4
    assert got.pop(blank) == "x y\nz" and wanted.pop(blank) == "x y\n\nz"  # what stands between goes too
    assert got == wanted and sum(d < len(texts) for d, _ in later) > 300
    assert sorted(str(r.text) for r in line_dedup.remove_repeated(docs).where("doc_id IS NULL").collect()) == ["", "None"]
