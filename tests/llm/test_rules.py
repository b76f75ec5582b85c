import re
from collections import Counter

from cooccur.llm import rules


def brute(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(own[i:i + 3]) for i in range(len(own) - 2))
    inside = {i + k for i in range(len(own) - 2) if grams[tuple(own[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


def test_statistics_and_verdicts(spark, odd_rows):
    clean = " ".join(f"Word{i} with other{i} text" for i in range(40))
    rows = [r[:2] for r in odd_rows] + [
        (300, clean), (301, clean.upper()), (302, "a b c d\n" * 40), (303, "###%%% " + "x%%% " * 80), (304, "line one\n \nline one\nline two\r\nline two\n"),
        (305, "from " * 100), (306, "\n".join(["the same long line of several words"] * 9)), (307, " ".join(str(i) for i in range(200)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = rules.cascade(docs, statistics=True, keep=("doc_id",)).collect()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r["doc_id"], *(r[c] for c in counts)) for r in found), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    verdict = {r["doc_id"]: r["rejected_by"] for r in found}
    assert verdict[300] is None and verdict[104] is None
    assert verdict[301] == "capitals" and verdict[307] == "words_without_letters" and verdict[100] == "few_words"
    assert all(verdict[i] for i in (302, 303, 304, 305, 306))


def test_order_does_not_change_the_verdict(odd):
    one = rules.cascade(odd, rules.RULES, keep=("doc_id", "n_chars")).where("rejected_by is null").count()
    assert one == rules.cascade(odd, rules.RULES[::-1], keep=("doc_id",)).where("rejected_by is null").count()


def test_rules_that_reject_more_per_second_come_first(odd):
    never = rules.Rule("never", lambda d: False)
    assert rules.ordered(odd, (never, rules.RULES[0]))[0].name == "few_words"
    report = {r["rule"]: r for r in rules.estimates(odd, (never,)).collect()}
    assert report["never"]["rejected"] == 0 and report["never"]["texts"] == odd.count()


def test_empty_and_clashing(empty, clashing):
    assert rules.cascade(empty, statistics=True).count() == 0
    assert rules.cascade(clashing).columns == [*clashing.columns, "rejected_by"]
