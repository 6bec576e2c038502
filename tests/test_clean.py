"""Golden unit tests of the silver cleaners on hand-made boundary rows (FIXTURES §4)."""

from churnlake.operators.clean import clean_features, clean_labels, clean_meta, cleaning_funnel
from churnlake.schema import RAW_FEATURE_COLUMNS, RAW_LABEL_COLUMNS, RAW_META_COLUMNS


def _feature_row(**kw):
    base = dict(customerID="C1", tenure="12", PhoneService="Yes", MultipleLines="No", InternetService="DSL",
                OnlineSecurity="No", OnlineBackup="No", DeviceProtection="No", TechSupport="No", StreamingTV="No",
                StreamingMovies="No", Contract="One year", PaperlessBilling="Yes", PaymentMethod="Mailed check",
                MonthlyCharges="56.95", TotalCharges="100.5", Snapshot_Date="1998-04-01")
    base.update(kw)
    return tuple(base[c] for c in RAW_FEATURE_COLUMNS)


def _features(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_FEATURE_COLUMNS))


def test_tenure_bounds(spark):
    vals = ["-1", "0", "12", "13", "73", "74", "5.7", "abc", None, " 7 "]
    rows = [_feature_row(customerID=f"C{i}", tenure=v) for i, v in enumerate(vals)]
    out = {r.customerID: r.tenure for r in clean_features(_features(spark, rows)).collect()}
    assert out == {"C1": 0, "C2": 12, "C3": 13, "C4": 73, "C6": 5, "C9": 7}


def test_charges_regex_semantics(spark):
    vals = {"$56.95": 56.95, "-5.0": 5.0, "1,234.5": 1.0, "12.": 12.0, "": None, None: None,
            "123.99": 123.99, "124": None, "0": None}
    rows = [_feature_row(customerID=f"C{i}", MonthlyCharges=v) for i, v in enumerate(vals)]
    got = {r.customerID: r.MonthlyCharges for r in clean_features(_features(spark, rows)).collect()}
    want = {f"C{i}": w for i, w in enumerate(vals.values()) if w is not None}
    assert got == want


def test_sentinels_case_and_blank(spark):
    rows = [
        _feature_row(customerID="A", InternetService="unknown"),
        _feature_row(customerID="B", InternetService="NOT SPECIFIED"),
        _feature_row(customerID="C", InternetService="Unknown "),  # trailing blank: not a sentinel
        _feature_row(customerID="D", InternetService=None),
        _feature_row(customerID="E", OnlineBackup="No internet service", MultipleLines="NO PHONE SERVICE"),
        _feature_row(customerID="F", PhoneService="yes", PaperlessBilling="Not Specified", PaymentMethod=None),
        _feature_row(customerID="G", PhoneService="unknown"),
    ]
    out = {r.customerID: r for r in clean_features(_features(spark, rows)).collect()}
    assert set(out) == {"C", "E", "F"}
    assert out["C"].InternetService == "Unknown "
    assert out["E"].OnlineBackup == "No" and out["E"].MultipleLines == "No"
    assert out["F"].PhoneService == 1 and out["F"].PaperlessBilling is None and out["F"].PaymentMethod == "Unknown"


def test_meta_and_labels(spark):
    meta = spark.createDataFrame(
        [("A", "male", "0", "Yes", "no", "1998-04-01"), ("B", "Female", "1", "No", "Yes", "1998-04-01"),
         ("C", "Unknown", "0", "Yes", "No", "1998-04-01"), ("D", "Male", "2", "Yes", "No", "1998-04-01"),
         ("E", "Male", "1", "maybe", "No", "1998-04-01")],
        ", ".join(f"{c} string" for c in RAW_META_COLUMNS))
    got = {r.customerID: (r.gender, r.SeniorCitizen, r.Partner, r.Dependents) for r in clean_meta(meta).collect()}
    assert got == {"A": (1, 0, 1, 0), "B": (0, 1, 0, 1)}
    labels = spark.createDataFrame([("A", "Yes", "1998-04-01"), ("B", "no", "1998-04-01"), ("C", "?", "bad"),
                                    ("D", None, "1998-04-01")], ", ".join(f"{c} string" for c in RAW_LABEL_COLUMNS))
    got = {r.customerID: (r.Churn, r.Snapshot_Date) for r in clean_labels(labels).collect()}
    assert got["A"][0] == 1 and got["B"][0] == 0 and got["C"] == (None, None) and got["D"][0] is None
    assert len(got) == 4  # labels keep unknown values as null


def test_clean_rows_pass_unchanged(spark):
    rows = [_feature_row(customerID=f"C{i}", tenure=str(i)) for i in range(1, 6)]
    out = clean_features(_features(spark, rows)).orderBy("customerID").collect()
    assert [r.customerID for r in out] == [f"C{i}" for i in range(1, 6)]
    for r in out:
        assert (r.InternetService, r.Contract, r.PaymentMethod, r.MonthlyCharges, r.TotalCharges) == (
            "DSL", "One year", "Mailed check", 56.95, 100.5)
    # cleaning the cleaned strings again changes nothing
    again = clean_features(_features(spark, [_feature_row(customerID=r.customerID, tenure=str(r.tenure),
                                                          MonthlyCharges=str(r.MonthlyCharges),
                                                          TotalCharges=str(r.TotalCharges)) for r in out]))
    assert sorted(again.collect()) == sorted(out)


def test_funnel_non_increasing_and_final_matches(spark):
    from churnlake.sources.fixtures import raw_feeds
    from conftest import SF_SMALL
    raw = raw_feeds(spark, SF_SMALL)["features"]
    steps = cleaning_funnel(raw, "features").orderBy("step_no").collect()
    counts = [r.rows for r in steps]
    assert all(a >= b for a, b in zip(counts, counts[1:]))
    assert counts[-1] == clean_features(raw).count()
    assert steps[0].rows == raw.count()
