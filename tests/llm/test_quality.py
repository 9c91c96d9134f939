from capplan.llm import quality


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


def prose(doc, n):
    return " ".join(f"d{doc}w{i}" for i in range(n))


def test_base_measures(spark):
    eight = "a b c d e f g h"
    texts = [
        (1, f"{eight} x {eight}"),
        (2, f"{eight}\n{eight}\n \n{eight}"),
        (3, "#* é|\x0bz"),
        (4, " ".join(["r"] * 30)),
        (5, None),
    ]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    rows = {r.doc_id: tuple(r)[1:] for r in quality.base_rules(frame, "doc_id").collect()}
    assert rows == {
        1: (17, 17, 0, 0, 16, True),
        2: (24, 24, 0, 2, 24, True),
        3: (3, 5, 3, 0, 0, True),
        4: (30, 30, 0, 0, 30, True),
        5: (0, 0, 0, 0, 0, True),
    }


def test_boilerplate_rejects_depleted_documents_only(spark):
    notice = " ".join(f"notice{i}" for i in range(30))
    rows = [(i, f"{notice}\n{prose(i, 60)}", "host", 1) for i in range(20)]
    rows += [(100 + i, f"{notice}\n{prose(100 + i, 5)}", "host", 1) for i in range(5)]
    rows += [(200, f"{notice}\n{prose(200, 5)}", "elsewhere", 1)]
    kept = {r.doc_id: r.kept for r in quality.judge(documents(spark, rows)).collect()}
    assert kept == {i: True for i in range(20)} | {100 + i: False for i in range(5)} | {200: True}
    cleaned = {r.doc_id: r for r in quality.clean_documents(documents(spark, rows)).collect()}
    assert set(cleaned) == {*range(20), 200}
    assert cleaned[3].text == prose(3, 60) and cleaned[3].n_chars == len(prose(3, 60))
    assert cleaned[200].text.startswith(notice) and cleaned[200].n_chars == 1


def test_exact_copies_do_not_reject_each_other(spark):
    text = "\n".join(prose(f"l{k}", 12) for k in range(6))
    rows = [(i, text if i % 2 else text.upper().replace("\n", "\n \n"), "host", 1) for i in range(40)]
    assert all(r.kept for r in quality.judge(documents(spark, rows)).collect())


def test_a_shared_menu_rejects_whatever_the_own_lines_are(spark):
    """100 documents of 40 menu lines and one own line: the count is of documents, for any own lines."""
    menu = "\n".join(prose(f"m{k}", 6) for k in range(40))
    rows = [
        (1000 * draw + i, f"{menu}\n" + " ".join(f"o{draw}x{i * 7919 % 101}y{w}" for w in range(25)), f"host{draw}", 1)
        for draw in range(20)
        for i in range(100)
    ]
    frame = documents(spark, rows)
    assert {r.n_docs for r in quality.boilerplate(frame).collect()} == {100}
    assert not any(r.kept for r in quality.judge(frame).collect())
    assert quality.clean_documents(frame).count() == 0


def test_limits_can_be_given(spark):
    menu = prose("m", 30)
    rows = [(i, f"{menu}\n{prose(i, 5)}", "host", 1) for i in range(6)]
    frame = documents(spark, rows)
    assert all(r.kept for r in quality.judge(frame).collect())
    assert not any(r.kept for r in quality.judge(frame, min_docs=5).collect())
    assert all(r.kept for r in quality.judge(frame, min_docs=5, min_share=1.1).collect())
    assert all(r.kept for r in quality.judge(frame, min_docs=5, min_left=0.1).collect())
    assert quality.clean_documents(frame, min_docs=5).count() == 0


def test_no_python_in_the_plan(spark, odd):
    plan = quality.judge(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_input(spark, odd, none):
    rows = sorted(((r.doc_id, r.n_words, r.kept) for r in quality.judge(odd).collect()), key=str)
    assert rows == sorted(
        [(1, 26, True), (2, 26, True), (2, 26, True), (3, 0, False), (4, 0, False), (5, 0, False), (6, 30000, True), (7, 30001, True), (8, 2, False), (None, 3, False)],
        key=str,
    )
    kept = quality.clean_documents(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 6, 7]
    assert quality.judge(none).count() == quality.clean_documents(none).count() == 0
