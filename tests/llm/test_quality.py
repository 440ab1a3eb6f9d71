import re
from collections import Counter

from eventstar.llm import quality as Q
from tests.llm.helpers import awkward, awkward_texts, docs_frame, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(hit), n < 50 or 100 * len(hit) > 50 * n)


def test_base_figures_match_brute_force():
    for t in [*awkward_texts(), "a b a b a b a b", "a a a a", "x|y # z\nx|y # z", "a b c\x1fd",
              "1 2 3 4 1 2 3", "w " * 70]:
        assert Q.judge(t)[:6] == brute(t), t


def test_many_distinct_words_use_the_wide_keys(monkeypatch):
    words = [str(i).encode() for i in range((1 << 20) + 10)] + [b"0", b"1", b"2"]
    assert Q.repeated_words(words) == 6


def test_lines_and_verdict():
    good = prose(5, 60)
    assert Q.judge(good)[-1]
    nav = " | ".join(f"Link{i}" for i in range(60))
    assert not Q.judge(nav + ".\n" + good[:100])[-1]
    assert Q.clean_lines(good + "\nSubscribe to our letter now.\nlast words.") == good + "\nlast words."
    assert not Q.line_passes("SHOUT!! SHOUT!! SHOUT!!", b"SHOUT!! SHOUT!! SHOUT!!".split(), False,
                             Q.QualityRules())


def test_frames(spark):
    docs = awkward(spark, clash="kept")
    rows = Q.quality_report(docs).collect()
    assert len(rows) == 14 and all(r.kept <= (not r.base_failed) for r in rows)
    kept = Q.filter_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        r.doc_id for r in rows if r.kept and r.doc_id is not None)
    assert Q.quality_report(docs_frame(spark, [])).count() == 0
    assert Q.filter_documents(docs_frame(spark, [])).count() == 0


def test_sound_documents_of_all_scripts_and_long_lines_stay():
    article = " ".join(f"w{i}" for i in range(200)) + " javascript " + " ".join(f"x{i}" for i in range(7)) + "."
    assert Q.judge(article)[-1]
    for end in "।؟。។…":
        lines = "\n".join(" ".join(f"{end}{i}k{j}" for j in range(12)) + end for i in range(8))
        assert Q.judge(lines)[-1] and Q.judge(lines)[-2] == 0
    assert Q.judge("\n".join(f"Read more about{i} c{i}." for i in range(60)))[-2] == 240
