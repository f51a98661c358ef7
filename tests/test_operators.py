"""Outcomes of operators that the driver's tables do not reach, one by one."""

from holdfast.operators import provenance, readiness, relink, runlogs, selection, statements


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_ban_list_drops_what_is_malformed(spark):
    static = spark.createDataFrame([("a" * 32,)], "id string")
    feed = spark.createDataFrame([('{"DPLA_id": "' + "b" * 32 + '"}',), ("not json",), ('{"DPLA_id": "x"}',), (None,)], "value string")
    assert rows(selection.ban_list(static, feed), "id") == [("a" * 32,), ("b" * 32,)]


def test_maintenance_drops_the_upload_flag_alone(spark):
    own = spark.createDataFrame([("h", "Q1", False, "a", "Q2", False), ("h", "Q1", None, "b", None, True), ("h", "Q1", None, "c", "Q3", True)], "hub string, hub_qid string, hub_upload boolean, inst string, inst_qid string, inst_upload boolean")
    assert rows(selection.eligible_institutions(own), "inst") == [("c",)]
    assert rows(selection.eligible_institutions(own, maintain=True), "inst") == [("a",), ("c",)]


def test_domain_without_items_has_no_largest(spark):
    kind = "domain string, inst string, is_eligible boolean, is_partner boolean, total int, unlim int, old_other int"
    own = spark.createDataFrame([("d", "x", True, False, 0, 0, 0), ("e", "y", True, True, 5, 5, 0), ("e", "z", False, False, 9, 1, 0), ("f", "b", True, False, 3, 1, 1), ("f", "a", False, False, 3, 1, 1)], kind)
    assert rows(readiness.by_domain(own), "domain", "largest", "total") == [("d", "", 0), ("f", "a", 6)]


def test_error_blocks_of_both_wordings(spark):
    item = "0" * 31 + "a"
    lines = [
        "[INFO] start",
        f"[ERROR] x -- Ordinal 3 (M12) for {item}: SDC sync failed; skipping ordinal.",
        "Traceback: ConnectionError",
        f"[ERROR] x -- Ordinal 4 (M13) for {item}: SDC sync failed after retries; skipping ordinal.",
        "ValueError",
        "[INFO] next",
        "timeout outside a block",
    ]
    log = spark.createDataFrame([("f", i, t) for i, t in enumerate(lines)], "file string, line_no int, text string")
    assert rows(runlogs.failed_ordinals(log), "ordinal", "entity", "id", "transient") == [(3, "M12", item, True), (4, "M13", item, False)]


def test_provenance_counts_a_return_as_a_change(spark):
    own = [("p", 1, "ann", {"t": "x", "d": "1"}), ("p", 2, "bob", {"d": "1"}), ("p", 3, "cy", {"t": "x", "d": "1"}), ("p", 4, "dee", {"t": "x"})]
    traced = provenance.trace(spark.createDataFrame(own, "page string, rev int, user string, params map<string,string>"))
    assert rows(traced, "key", "value", "user") == [("t", "x", "cy")]


def test_reconcile_is_done_after_its_actions(spark):
    kind = "entity int, prop string, value string"
    expected = spark.createDataFrame([(1, "P", "a"), (1, "P", "b"), (1, "P", "c")], kind)
    existing = spark.createDataFrame([(1, "P", "a", True, False), (1, "P", "z", True, False), (1, "P", "c", False, False), (1, "P", "y", False, True)], kind + ", ours boolean, foreign boolean")
    assert rows(statements.reconcile(expected, existing), "value", "action") == [("a", "keep"), ("b", "add"), ("c", "annotate"), ("y", "ignore"), ("z", "remove")]
    after = spark.createDataFrame([(1, "P", v, True, False) for v in "abc"] + [(1, "P", "y", False, True)], kind + ", ours boolean, foreign boolean")
    assert set(rows(statements.reconcile(expected, after), "action")) == {("keep",), ("ignore",)}


def test_merged_statement_goes_with_its_last_owner(spark):
    refs = spark.createDataFrame([(1, "s1", "v", "a"), (1, "s1", "v", "b"), (1, "s2", "w", "a"), (1, "s3", "u", "x")], "entity int, stmt string, value string, owner string")
    expected = spark.createDataFrame([(1, "b", "v"), (1, "c", "v")], "entity int, owner string, value string")
    loaded = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "entity int, owner string")
    assert rows(statements.reconcile_merged(refs, expected, loaded), "stmt", "owners", "action") == [("s1", ["b", "c"], "keep"), ("s2", [], "remove"), ("s3", ["x"], "keep")]


def test_relink_stops_where_it_is_ambiguous(spark):
    live = spark.createDataFrame([("i1", "http://a.org/rec/123456", "s"), ("i2", "http://b.org/x", "s"), ("i3", "https://b.org/x/", "s"), ("i4", "http://c.org/k/777777", "t")], "id string, shown_at string, scope string")
    files = spark.createDataFrame(
        [("f1", "i4", None, None), ("f2", None, "https://a.org/rec/123456/", None), ("f3", None, "http://b.org/x", "s"), ("f4", "gone", "http://old.org/k/777777", "t"), ("f5", None, None, None)],
        "file string, embedded_id string, url string, scope string",
    )
    assert rows(relink.relink(files, live), "file", "anchor") == [("f1", "embedded"), ("f2", "shown_at"), ("f3", "ambiguous"), ("f4", "token"), ("f5", "unresolved")]


def test_retry_sets_in_order(spark):
    of = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    found = runlogs.retry_sets(of(1, 2, 3), of(2, 4), of(4, 5, 1), of(1), ["id"])
    assert rows(found, "id", "phase") == [(1, "sync"), (2, "download"), (3, "download"), (4, "upload"), (5, "sync")]


def test_relink_finds_tokens_inside_longer_ones(spark):
    live = spark.createDataFrame(
        [("i1", "http://a.org/dlg_abc_337", "s"), ("i2", "http://a.org/zzz777b", "t"), ("i3", "http://a.org/zzz777", "t"), ("i4", "http://a.org/q/dlg_abc_337", "u"), ("i5", None, "s")], "id string, shown_at string, scope string"
    )
    files = spark.createDataFrame([("f1", None, "http://old.org/abc_337", "s"), ("f2", None, "http://old.org/zzz777", "t"), ("f3", None, "http://old.org/abc_338", "s")], "file string, embedded_id string, url string, scope string")
    assert rows(relink.relink(files, live), "file", "anchor") == [("f1", "token"), ("f2", "ambiguous"), ("f3", "unresolved")]


def test_series_letters_are_by_language(spark):
    long = "word " * 600
    own = spark.createDataFrame([(1, "P", "en", 0, long), (1, "P", "fr", 1, long), (1, "P", "en", 2, long), (1, "P", None, 3, long)], "id int, prop string, language string, pos int, value string")
    found = statements.long_values(own).where("part = 0")
    assert [r["letter"] for r in found.orderBy("pos").collect()] == ["A", "A", "B", "A"]


def test_malformed_statements_of_ours_go(spark):
    expected = spark.createDataFrame([(1, "P", "a")], "entity int, prop string, value string")
    existing = spark.createDataFrame(
        [(1, "P", "a", True, False, False), (1, "P", "a", True, False, True), (1, "T", None, True, False, True), (1, "P", "q", False, True, True)], "entity int, prop string, value string, ours boolean, foreign boolean, malformed boolean"
    )
    found = statements.reconcile(expected, existing, ("T",)).collect()
    assert sorted((r["prop"], r["value"] or "", r["action"]) for r in found) == [("P", "a", "keep"), ("P", "a", "remove"), ("P", "q", "ignore"), ("T", "", "remove")]
