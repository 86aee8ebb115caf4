import brute
import pytest

from tidemark.llm import quality_rules as q


def test_counts_equal_brute_force(docs, rows):
    got = {r.doc_id: r for r in q.judge_documents(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        n = brute.base_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n, i
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.kept and r.base_failed)


@pytest.mark.parametrize("line,ok", [
    ("A plain sentence that ends as it should, with a full stop and more than twelve words in it.", True),
    ("a long run of words that never comes to an end and has no terminal mark at all in it", False),
    ("Short heading", True), ("Home", False), ("Next | Previous | Home | About us | Help", False),
    ("All rights reserved.", False), ("Please enable JavaScript to go on.", False),
    ("BUY!! NOW!! CHEAP!! ALL!!", False), ("Really? Yes! That is so.", True), ("a$$$ b### c*** d%%%.", False),
    ("句子很长。", True)])
def test_line_rules(line, ok):
    assert q.LineJudge(q.LineRules()).keeps(line) is ok


def test_lines_go_before_the_verdict(spark):
    good = ("These are words of a sentence that any reader would call quite plain and clean. " * 2).strip()
    body = "\n".join(f"{good} {'x' * (i + 1)} ends here." for i in range(6))
    d = spark.createDataFrame([(1, body, 5), (2, body + "\nHome\nAll rights reserved.", 5), (3, "Home\n" * 80 + body[:100], 5), (4, None, 5)],
                              "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in q.clean_documents(d, q.LineRules(max_repeat_pct=100)).collect()}
    assert set(got) == {1, 2} and got[1].text == body and got[1].n_chars == 5
    assert got[2].text == body and got[2].n_chars == len(body)


def test_columns_empty_and_repeats(docs, none, repeated):
    assert q.clean_documents(docs).schema.names == docs.schema.names
    assert q.clean_documents(none).count() == 0 and q.judge_documents(none).count() == 0
    assert q.judge_documents(repeated).count() == repeated.count()
