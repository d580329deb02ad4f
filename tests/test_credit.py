"""The credit plan against plain pandas on small random tables."""

import credit_data
import numpy as np
import pandas as pd
import pytest
from tributary.plans import credit

FNS = {"mean": "mean", "sum": "sum", "min": "min", "max": "max", "var": "var", "count": "count", "size": "size", "nunique": "nunique"}


@pytest.fixture(scope="module")
def frames():
    return credit_data.make()


@pytest.fixture(scope="module")
def tables(spark, frames):
    return credit_data.to_spark(spark, frames)


def grouped(df, spec, prefix):
    g = df.groupby("SK_ID_CURR")
    out = {f"{prefix}{c}_{f.upper()}": g[c].agg(FNS[f]) if f != "size" else g.size() for c, fs in spec.items() for f in fs}
    return pd.DataFrame(out)


def dummies(df, skip=()):
    strings = [c for c in df.columns if df[c].dtype == object and c not in skip]
    out = pd.get_dummies(df, columns=strings, dummy_na=True, dtype=int)
    return out, [c for c in out.columns if c not in df.columns]


def check(block: pd.DataFrame, expected: pd.DataFrame):
    got = block.set_index("SK_ID_CURR").sort_index()
    missing = [c for c in expected.columns if c not in got.columns]
    assert not missing, missing[:5]
    joined = expected.reindex(got.index)
    for c in expected.columns:
        a = got[c].astype(float).to_numpy()
        b = joined[c].astype(float).to_numpy()
        np.testing.assert_allclose(a, b, rtol=1e-8, atol=1e-6, err_msg=c)


def windows(limits, unlimited):
    return [*limits, None] if unlimited else list(limits)


def label(limit):
    return "False" if limit is None else str(limit)


@pytest.mark.parametrize("level", [1, 2])
def test_bureau(frames, tables, level):
    days, everything = (credit.LEVEL1_DAYS, True) if level == 1 else (credit.LEVEL2_DAYS, False)
    spec = credit.BUREAU_LEVEL1 if level == 1 else credit.level2_spec(credit.BUREAU_LEVEL1)
    months, month_cols = dummies(frames["bureau_balance"])
    g = months.groupby("SK_ID_BUREAU")
    rolled = pd.DataFrame(
        {
            "MONTHS_BALANCE_MIN": g["MONTHS_BALANCE"].min(),
            "MONTHS_BALANCE_MAX": g["MONTHS_BALANCE"].max(),
            "MONTHS_BALANCE_SIZE": g.size(),
            **{f"{c}_MEAN": g[c].mean() for c in month_cols},
        }
    )
    df, cats = dummies(frames["bureau"].assign(status=frames["bureau"]["CREDIT_ACTIVE"]), skip=("status",))
    df = df.join(rolled, on="SK_ID_BUREAU")
    parts = []
    for limit in windows(days, everything):
        seen = df if limit is None else df[df["DAYS_CREDIT"] >= -limit]
        cat_spec = {c: ("mean",) for c in [*cats, *(f"{c}_MEAN" for c in month_cols)]}
        lab = label(limit)
        parts.append(grouped(seen, {**spec, **cat_spec}, f"{lab}_bb_BURO_"))
        parts.append(grouped(seen[seen["status"] == "Active"], spec, f"{lab}_bb_ACTIVE_"))
        parts.append(grouped(seen[seen["status"] == "Closed"], spec, f"{lab}_bb_CLOSED_"))
    block = credit.bureau_block(tables.bureau, tables.bureau_balance, days, everything, spec).toPandas()
    check(block, pd.concat(parts, axis=1))
    assert not [c for c in block.columns if "ACTIVE_CREDIT_TYPE" in c]


@pytest.mark.parametrize("level", [1, 2])
def test_previous(frames, tables, level):
    days, everything = (credit.LEVEL1_DAYS, True) if level == 1 else (credit.LEVEL2_DAYS, False)
    spec = credit.PREVIOUS_LEVEL1 if level == 1 else credit.level2_spec(credit.PREVIOUS_LEVEL1)
    df = frames["previous_application"].copy()
    df["DAYS_FIRST_DUE"] = df["DAYS_FIRST_DUE"].replace(365243, np.nan)
    df["APP_CREDIT_PERC"] = (df["AMT_APPLICATION"] / df["AMT_CREDIT"]).replace([np.inf, -np.inf], np.nan)
    df, cats = dummies(df.assign(status=df["NAME_CONTRACT_STATUS"]), skip=("status",))
    parts = []
    for limit in windows(days, everything):
        seen = df if limit is None else df[df["DAYS_FIRST_DUE"] > -limit]
        lab = label(limit)
        parts.append(grouped(seen, {**spec, **{c: ("mean",) for c in cats}}, f"{lab}_prevapp_PREV_"))
        parts.append(grouped(seen[seen["status"] == "Approved"], spec, f"{lab}_prevapp_APPROVED_"))
        parts.append(grouped(seen[seen["status"] == "Refused"], spec, f"{lab}_prevapp_REFUSED_"))
    block = credit.previous_block(tables.previous_application, days, everything, spec).toPandas()
    check(block, pd.concat(parts, axis=1))


@pytest.mark.parametrize("level", [1, 2])
def test_instalments(frames, tables, level):
    days, everything = (credit.LEVEL1_DAYS, True) if level == 1 else (credit.LEVEL2_DAYS, False)
    spec = credit.INSTALMENT_LEVEL1 if level == 1 else credit.level2_spec(credit.INSTALMENT_LEVEL1)
    df = frames["installments_payments"].copy()
    df["PAYMENT_PERC"] = (df["AMT_PAYMENT"] / df["AMT_INSTALMENT"]).replace([np.inf, -np.inf], np.nan)
    df["PAYMENT_DIFF"] = df["AMT_INSTALMENT"] - df["AMT_PAYMENT"]
    late = df["DAYS_ENTRY_PAYMENT"] - df["DAYS_INSTALMENT"]
    df["DPD"], df["DBD"] = late.where(late > 0, 0), (-late).where(late < 0, 0)
    parts = []
    for limit in windows(days, everything):
        seen = df if limit is None else df[df["DAYS_INSTALMENT"] >= -limit]
        lab = label(limit)
        parts.append(grouped(seen, spec, f"{lab}_instpay_INSTAL_"))
        parts.append(seen.groupby("SK_ID_CURR").size().to_frame(f"{lab}_instpay_INSTAL_COUNT"))
    block = credit.instalment_block(tables.installments_payments, days, everything, spec).toPandas()
    check(block, pd.concat(parts, axis=1))


def test_pos_and_card(frames, tables):
    df, cats = dummies(frames["pos_cash_balance"])
    parts = []
    for limit in windows(credit.LEVEL1_MONTHS, True):
        seen = df if limit is None else df[df["MONTHS_BALANCE"] >= -limit]
        spec = {**credit.POS_LEVEL1, **{c: ("mean",) for c in cats}}
        parts.append(grouped(seen, spec, f"{label(limit)}_poscash_POS_"))
        parts.append(seen.groupby("SK_ID_CURR").size().to_frame(f"{label(limit)}_poscash_POS_COUNT"))
    check(credit.pos_block(tables.pos_cash_balance, credit.LEVEL1_MONTHS, True).toPandas(), pd.concat(parts, axis=1))

    df, _ = dummies(frames["credit_card_balance"].drop(columns="SK_ID_PREV"))
    spec = {c: ("min", "max", "mean", "sum", "var") for c in df.columns if c != "SK_ID_CURR"}
    seen = df[df["MONTHS_BALANCE"] >= -12]
    parts = [
        grouped(seen, spec, "12_credditcard_CC_"),
        seen.groupby("SK_ID_CURR").size().to_frame("12_credditcard_CC_COUNT"),
    ]
    check(credit.card_block(tables.credit_card_balance, (12,), False).toPandas(), pd.concat(parts, axis=1))


def test_application(frames, tables):
    df = pd.concat([frames["application_train"], frames["application_test"]], ignore_index=True)
    df = df[df["CODE_GENDER"] != "XNA"].copy()
    df["DAYS_EMPLOYED"] = df["DAYS_EMPLOYED"].replace(365243, np.nan)
    ext = list(credit.EXT)
    want = df[["SK_ID_CURR"]].copy()
    for c in ext:
        want[f"{c}p"] = pd.qcut(df[c], 100, labels=False, duplicates="drop")
    want["EXT_SOURCE_3pm"] = want[[f"{c}p" for c in ext]].mean(axis=1)
    df[ext] = df[ext].fillna(df[ext].median())
    want[ext] = df[ext]
    want["NEW_DOC_IND_KURT"] = df[[c for c in df.columns if "FLAG_DOC" in c]].kurtosis(axis=1)
    want["NEW_LIVE_IND_SUM"] = df[["FLAG_MOBIL", "FLAG_EMAIL"]].sum(axis=1)
    want["NEW_SCORES_STD"] = df[ext].std(axis=1)
    want["NEW_INC_BY_ORG"] = df.groupby("ORGANIZATION_TYPE")["AMT_INCOME_TOTAL"].transform("median")
    moved = {c: df[c] + abs(df[c].min()) for c in ("DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH")}
    want["NEW_EMPLOY_TO_BIRTH_RATIO"] = df["DAYS_EMPLOYED"] / moved["DAYS_BIRTH"]
    want["NEW_PHONE_TO_BIRTH_RATIO"] = df["DAYS_LAST_PHONE_CHANGE"] / moved["DAYS_EMPLOYED"]
    want["NEW_CREDIT_TO_ANNUITY_RATIO"] = df["AMT_CREDIT"] / df["AMT_ANNUITY"]
    want["f_15"] = moved["DAYS_BIRTH"] / moved["DAYS_REGISTRATION"]
    want["f_17"] = moved["DAYS_BIRTH"] / moved["DAYS_ID_PUBLISH"]
    once = np.log10(df["AMT_ANNUITY"])
    want["AMT_ANNUITY"] = np.log10(once)
    want["f_12"] = np.log10(np.log10(df["AMT_GOODS_PRICE"])) / np.log10(once)
    for c in ("CODE_GENDER", "NAME_EDUCATION_TYPE"):
        want[f"{c}_AMT_ANNUITY_f1_mean"] = df[c].map(once.groupby(df[c]).mean())
        want[f"{c}_AMT_ANNUITY_f1_std"] = df[c].map(once.groupby(df[c]).std())
    want["CODE_GENDER"] = df["CODE_GENDER"].map({"F": 0, "M": 1})
    want["ORGANIZATION_TYPE_School"] = (df["ORGANIZATION_TYPE"] == "School").astype(int)
    want = want.replace([np.inf, -np.inf], np.nan).set_index("SK_ID_CURR")
    check(credit.application_features(tables, bins=100).toPandas(), want)


def test_matrices_keep_every_entity(frames, tables):
    n = sum(len(frames[f"application_{p}"]) for p in ("train", "test")) - 1
    wide = credit.level2_matrix(tables)
    ids = [r["SK_ID_CURR"] for r in wide.select("SK_ID_CURR").collect()]
    assert len(ids) == len(set(ids)) == n
    for c in ("f70", "f76", "f88", "360_bb_ACTIVE_DAYS_CREDIT_ENDDATE_MIN", "12_credditcard_CC_COUNT"):
        assert c in wide.columns


def test_pruning_matches_the_full_matrix(spark, tables):
    full = credit.level1_matrix(tables)
    names = [
        "f_12", "NEW_SCORES_STD", "False_bb_BURO_AMT_CREDIT_SUM_MEAN", "90_bb_ACTIVE_DAYS_CREDIT_MEAN",
        "12_poscash_POS_COUNT", "360_instpay_INSTAL_DPD_MEAN", "90_instpay_INSTAL_DPD_MEAN",
    ]
    rows = [(n, 11.0) for n in names] + [("CNT_CHILDREN", 10.0)]
    prior = spark.createDataFrame(rows, "feature string, importance double")
    pruned = credit.level1_matrix(tables, ["INSTAL_DPD_MEAN"], prior)
    kept = [n for n in names if not n.endswith("INSTAL_DPD_MEAN")]
    assert set(pruned.columns) == {"SK_ID_CURR", "TARGET", *kept}
    columns = ["SK_ID_CURR", *kept]
    got = pruned.select(columns).toPandas().set_index("SK_ID_CURR").sort_index()
    want = full.select(columns).toPandas().set_index("SK_ID_CURR").sort_index()
    pd.testing.assert_frame_equal(got, want)


def test_windows_are_nested(tables):
    block = credit.instalment_block(tables.installments_payments, credit.LEVEL1_DAYS, True).toPandas()
    counts = block[[f"{w}_instpay_INSTAL_COUNT" for w in ("90", "180", "270", "360", "False")]].fillna(0)
    assert (counts.diff(axis=1).iloc[:, 1:] >= 0).all().all()


def test_wide_names_survive_a_written_table(spark, tables):
    from tributary.session import materialize

    names = credit.application_features(tables)
    kept = materialize(names.select("SK_ID_CURR", *[c for c in names.columns if " " in c or ":" in c]), "names")
    assert any("/" in c for c in kept.columns) and kept.count() == 119
