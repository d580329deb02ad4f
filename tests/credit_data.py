"""Small random credit tables with missing values, sentinels and absent histories."""

from __future__ import annotations

import numpy as np
import pandas as pd


def _maybe(rng, values, share=0.2):
    out = np.asarray(values, dtype=float)
    out[rng.random(len(out)) < share] = np.nan
    return out


def _pick(rng, values, n, missing=0.0):
    out = np.array(values, dtype=object)[rng.integers(0, len(values), n)]
    out[rng.random(n) < missing] = None
    return out


def make(n: int = 120, seed: int = 5) -> dict[str, pd.DataFrame]:
    rng = np.random.default_rng(seed)
    ids = np.arange(100, 100 + n)
    app = pd.DataFrame(
        {
            "SK_ID_CURR": ids,
            "TARGET": (rng.random(n) < 0.35).astype(int),
            "CODE_GENDER": _pick(rng, ["F", "M"], n),
            "FLAG_OWN_CAR": _pick(rng, ["N", "Y"], n),
            "FLAG_OWN_REALTY": _pick(rng, ["N", "Y"], n),
            "NAME_EDUCATION_TYPE": _pick(rng, ["Higher", "Secondary / special", "Lower"], n, 0.05),
            "ORGANIZATION_TYPE": _pick(rng, ["School", "Trade: type 1", "Other"], n),
            "AMT_INCOME_TOTAL": rng.integers(30_000, 300_000, n).astype(float),
            "AMT_CREDIT": rng.integers(50_000, 900_000, n).astype(float),
            "AMT_ANNUITY": _maybe(rng, rng.integers(5_000, 60_000, n), 0.05),
            "AMT_GOODS_PRICE": _maybe(rng, rng.integers(40_000, 800_000, n), 0.05),
            "CNT_CHILDREN": rng.integers(0, 4, n),
            "OWN_CAR_AGE": _maybe(rng, rng.integers(0, 30, n), 0.5),
            "EXT_SOURCE_1": _maybe(rng, rng.random(n), 0.4),
            "EXT_SOURCE_2": _maybe(rng, rng.random(n), 0.1),
            "EXT_SOURCE_3": _maybe(rng, rng.random(n), 0.2),
            "DAYS_BIRTH": -rng.integers(8_000, 25_000, n),
            "DAYS_EMPLOYED": np.where(rng.random(n) < 0.2, 365243, -rng.integers(1, 9_000, n)),
            "DAYS_REGISTRATION": -rng.integers(1, 9_000, n).astype(float),
            "DAYS_ID_PUBLISH": -rng.integers(1, 6_000, n),
            "DAYS_LAST_PHONE_CHANGE": -rng.integers(0, 3_000, n).astype(float),
            "FLAG_DOCUMENT_2": rng.integers(0, 2, n),
            "FLAG_DOCUMENT_3": rng.integers(0, 2, n),
            "FLAG_DOCUMENT_4": rng.integers(0, 2, n),
            "FLAG_DOCUMENT_5": rng.integers(0, 2, n),
            "FLAG_MOBIL": rng.integers(0, 2, n),
            "FLAG_EMAIL": rng.integers(0, 2, n),
            "DEF_30_CNT_SOCIAL_CIRCLE": rng.integers(0, 3, n).astype(float),
            "DEF_60_CNT_SOCIAL_CIRCLE": rng.integers(0, 3, n).astype(float),
            "OBS_30_CNT_SOCIAL_CIRCLE": rng.integers(0, 4, n).astype(float),
            "OBS_60_CNT_SOCIAL_CIRCLE": rng.integers(0, 4, n).astype(float),
            "REGION_RATING_CLIENT_W_CITY": rng.integers(1, 4, n),
        }
    )
    app.loc[0, "CODE_GENDER"] = "XNA"
    cut = int(n * 0.75)
    train, test = app.iloc[:cut], app.iloc[cut:].drop(columns="TARGET")

    m = n * 4
    bureau = pd.DataFrame(
        {
            "SK_ID_CURR": rng.choice(ids[: n - 10], m),
            "SK_ID_BUREAU": np.arange(m) + 5000,
            "CREDIT_ACTIVE": _pick(rng, ["Active", "Closed", "Sold"], m, 0.05),
            "CREDIT_TYPE": _pick(rng, ["Consumer credit", "Microloan"], m),
            "DAYS_CREDIT": -rng.choice([5, 80, 90, 91, 180, 250, 360, 361, 900], m),
            "DAYS_CREDIT_ENDDATE": _maybe(rng, rng.integers(-900, 900, m)),
            "DAYS_CREDIT_UPDATE": -rng.integers(1, 500, m),
            "CREDIT_DAY_OVERDUE": rng.integers(0, 3, m),
            "AMT_CREDIT_MAX_OVERDUE": _maybe(rng, rng.integers(0, 5000, m), 0.6),
            "AMT_CREDIT_SUM": _maybe(rng, rng.integers(1000, 90_000, m), 0.05),
            "AMT_CREDIT_SUM_DEBT": _maybe(rng, rng.integers(0, 90_000, m)),
            "AMT_CREDIT_SUM_OVERDUE": rng.integers(0, 100, m).astype(float),
            "AMT_CREDIT_SUM_LIMIT": _maybe(rng, rng.integers(0, 9000, m), 0.5),
            "AMT_ANNUITY": _maybe(rng, rng.integers(0, 9000, m), 0.7),
            "CNT_CREDIT_PROLONG": rng.integers(0, 2, m),
        }
    )
    k = m * 3
    balance = pd.DataFrame(
        {
            "SK_ID_BUREAU": rng.choice(np.arange(m - 40) + 5000, k),
            "MONTHS_BALANCE": -rng.integers(0, 60, k),
            "STATUS": _pick(rng, ["0", "1", "C", "X"], k),
        }
    )
    previous = pd.DataFrame(
        {
            "SK_ID_CURR": rng.choice(ids[5:], m),
            "SK_ID_PREV": np.arange(m) + 90_000,
            "NAME_CONTRACT_STATUS": _pick(rng, ["Approved", "Refused", "Canceled"], m),
            "NAME_TYPE_SUITE": _pick(rng, ["Family", "Children"], m, 0.3),
            "AMT_ANNUITY": _maybe(rng, rng.integers(1000, 50_000, m)),
            "AMT_APPLICATION": rng.integers(0, 90_000, m).astype(float),
            "AMT_CREDIT": rng.choice([0.0, 10_000.0, 45_000.0, 70_500.0], m),
            "AMT_DOWN_PAYMENT": _maybe(rng, rng.integers(0, 5000, m), 0.5),
            "AMT_GOODS_PRICE": _maybe(rng, rng.integers(1000, 90_000, m)),
            "HOUR_APPR_PROCESS_START": rng.integers(0, 24, m),
            "RATE_DOWN_PAYMENT": _maybe(rng, rng.random(m), 0.5),
            "DAYS_DECISION": -rng.integers(1, 2000, m),
            "CNT_PAYMENT": _maybe(rng, rng.integers(0, 60, m)),
            "DAYS_FIRST_DRAWING": rng.choice([365243.0, -100.0], m),
            "DAYS_FIRST_DUE": _maybe(rng, rng.choice([365243, -30, -90, -89, -360, -359, -900], m)),
            "DAYS_LAST_DUE_1ST_VERSION": rng.choice([365243.0, -10.0], m),
            "DAYS_LAST_DUE": rng.choice([365243.0, -10.0], m),
            "DAYS_TERMINATION": rng.choice([365243.0, -5.0], m),
        }
    )
    pos = pd.DataFrame(
        {
            "SK_ID_CURR": rng.choice(ids[10:], m),
            "SK_ID_PREV": rng.integers(90_000, 90_400, m),
            "MONTHS_BALANCE": -rng.integers(1, 40, m),
            "CNT_INSTALMENT_FUTURE": _maybe(rng, rng.integers(0, 60, m)),
            "NAME_CONTRACT_STATUS": _pick(rng, ["Active", "Completed"], m),
            "SK_DPD": rng.integers(0, 4, m),
            "SK_DPD_DEF": rng.integers(0, 2, m),
        }
    )
    payments = pd.DataFrame(
        {
            "SK_ID_CURR": rng.choice(ids[15:], m),
            "SK_ID_PREV": rng.integers(90_000, 90_400, m),
            "NUM_INSTALMENT_VERSION": rng.integers(0, 5, m),
            "DAYS_INSTALMENT": -rng.choice([10, 90, 180, 181, 300, 360, 1200], m),
            "DAYS_ENTRY_PAYMENT": _maybe(rng, -rng.integers(1, 1200, m), 0.1),
            "AMT_INSTALMENT": rng.choice([0.0, 1200.5, 9000.0, 4300.25], m),
            "AMT_PAYMENT": _maybe(rng, rng.integers(100, 9000, m), 0.1),
        }
    )
    card = pd.DataFrame(
        {
            "SK_ID_CURR": rng.choice(ids[20:], m),
            "SK_ID_PREV": rng.integers(90_000, 90_400, m),
            "MONTHS_BALANCE": -rng.integers(1, 30, m),
            "AMT_BALANCE": rng.integers(0, 9000, m).astype(float),
            "AMT_INST_MIN_REGULARITY": _maybe(rng, rng.integers(0, 900, m)),
            "AMT_PAYMENT_CURRENT": _maybe(rng, rng.integers(0, 900, m)),
            "CNT_INSTALMENT_MATURE_CUM": _maybe(rng, rng.integers(0, 30, m)),
            "NAME_CONTRACT_STATUS": _pick(rng, ["Active", "Signed"], m),
            "SK_DPD": rng.integers(0, 3, m),
        }
    )
    return {
        "application_train": train,
        "application_test": test,
        "bureau": bureau,
        "bureau_balance": balance,
        "previous_application": previous,
        "pos_cash_balance": pos,
        "installments_payments": payments,
        "credit_card_balance": card,
    }


def to_spark(spark, frames: dict[str, pd.DataFrame]):
    from tributary.functions.nulls import nan_to_null
    from tributary.plans.credit import CreditTables

    made = {}
    for name, frame in frames.items():
        frame = frame.copy()
        for c in frame.columns[frame.dtypes == object]:
            frame[c] = frame[c].where(frame[c].notna(), None)
        made[name] = nan_to_null(spark.createDataFrame(frame))
    return CreditTables(**made)
