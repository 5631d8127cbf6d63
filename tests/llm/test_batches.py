"""What workers hold at once and what is left on disk do not grow with a batch or with the steps of an operator."""

import numpy as np
import pandas as pd

from ripplelake.llm import decontaminate, line_templates, suffix_dedup


def test_lines_are_passed_on_before_a_batch_ends(monkeypatch):
    part = pd.DataFrame({"h": [1, 2], "doc_id": [1, 2], "text": ["\n".join(f"line {n} of a text" for n in range(500)), None]})
    whole = list(line_templates._lines(iter([part])))
    monkeypatch.setattr(line_templates, "ROWS", 64)
    parts = list(line_templates._lines(iter([part, part])))
    assert len(whole) == 1 and len(parts) > 10 and max(map(len, parts)) < 64 + 5
    assert pd.concat(parts, ignore_index=True).equals(pd.concat(whole * 2, ignore_index=True))


def test_texts_hashed_together_have_the_hits_of_each():
    hashes = decontaminate.Hashes()
    item = " ".join(f"w{n}" for n in range(30))
    index = decontaminate.Index([(7, hashes(item)), (8, hashes("a few words"))])
    words = item.split()
    texts = ["", item, " ".join(words[:15]), " ".join(words[15:]), "x " + item + " y", None, "a few words", "a few"]
    tokens = [hashes(t) for t in texts]
    assert index.hits(tokens) == [index.hits([t])[0] for t in tokens]
    assert [bool(x) for x in index.hits(tokens)] == [False, True, True, True, True, False, True, False]
    assert index.hits([]) == []
    # Cut between two texts, a passage is in neither.
    halves = [hashes(" ".join(words[:6])), hashes(" ".join(words[6:11]))]
    assert index.hits(halves) == [set(), set()]
    assert [(a, len(t)) for a, t in decontaminate._together(iter([np.zeros(9_000)] * 5))] == [(0, 2), (2, 2), (4, 1)]


def test_segments_go_once_the_rows_they_decide_are_stored(spark, tmp_path, monkeypatch):
    made = []
    stored = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, purpose: made.append((purpose, stored(df, purpose))) or made[-1][1])
    text = "".join(chr(97 + n * n % 23) + chr(97 + n % 19) for n in range(200))
    docs = spark.createDataFrame([(1, text), (2, "x" + text), (3, text[100:] + "other"), (None, None)], "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in suffix_dedup.report(docs).collect()}
    assert found == {1: 0, 2: 400, 3: 300, None: 0}
    left = [purpose for purpose, df in made if purpose in ("segments", "strings", "gone")]
    assert left == ["segments", "gone", "strings", "gone"]
    folder = made[[p for p, _ in made].index("segments")][1].inputFiles()[0].removeprefix("file:").rpartition("/")[0]
    import os

    assert not os.path.exists(folder)
