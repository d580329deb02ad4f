"""The credit-default jobs on their own tables: features, level 1, level 2, selection.

``CreditTables`` holds the eight inputs.  ``level1_matrix`` and ``level2_matrix``
build the wide feature tables, ``train_models`` runs the boosters, and
``select_by_null_importance`` repeats training on permuted labels and keeps the
features that beat their null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import MISSING_DATE, is_not, nan_to_null, sentinel_to_null
from ..functions.ratios import global_value, payment_features, product, ratio, safe_log10, shifted, shifted_ratio
from ..functions.rowstats import row_mean, row_sum, with_row_kurtosis, with_row_std
from ..operators import assemble, boosting, encode, importance, lookup, selection
from ..operators.aggspec import ALL6, BLANKET5, blanket_spec
from ..operators.ordered import exact_quantiles
from ..operators.rollup import child_rollup
from ..operators.windowed import Slices, Windows, spread, windowed_agg
from ..session import materialize
from ..sources import sinks
from ..sources.files import read_csv, stage_zip

Keep = Callable[[str], bool] | None
KEY = "SK_ID_CURR"
LABEL = "TARGET"

# Window lengths per table (days or months) of the two levels.
LEVEL1_DAYS = (90, 180, 270, 360)
LEVEL1_MONTHS = (3, 6, 9, 12)
LEVEL2_DAYS = (360,)
LEVEL2_MONTHS = (12,)

# Numeric aggregates of each history block at level 1.
BUREAU_LEVEL1 = {
    "DAYS_CREDIT": ("mean", "var"),
    "DAYS_CREDIT_ENDDATE": ("mean",),
    "DAYS_CREDIT_UPDATE": ("mean",),
    "CREDIT_DAY_OVERDUE": ("mean", "count"),
    "AMT_CREDIT_MAX_OVERDUE": ("mean",),
    "AMT_CREDIT_SUM": ("mean", "sum"),
    "AMT_CREDIT_SUM_DEBT": ("mean", "sum"),
    "AMT_CREDIT_SUM_OVERDUE": ("mean",),
    "AMT_CREDIT_SUM_LIMIT": ("mean", "sum"),
    "AMT_ANNUITY": ("max", "mean", "sum"),
    "CNT_CREDIT_PROLONG": ("sum",),
    "MONTHS_BALANCE_MIN": ("min",),
    "MONTHS_BALANCE_MAX": ("max",),
    "MONTHS_BALANCE_SIZE": ("mean", "sum"),
}
PREVIOUS_LEVEL1 = {
    "AMT_ANNUITY": ("max", "mean", "sum"),
    "AMT_APPLICATION": ("min", "mean"),
    "AMT_CREDIT": ("min", "max", "mean"),
    "APP_CREDIT_PERC": ("min", "max", "mean"),
    "AMT_DOWN_PAYMENT": ("min", "max", "mean"),
    "AMT_GOODS_PRICE": ("min", "max", "mean", "sum"),
    "HOUR_APPR_PROCESS_START": ("min", "max", "mean"),
    "RATE_DOWN_PAYMENT": ("min", "max", "mean"),
    "DAYS_DECISION": ("min", "max", "mean"),
    "CNT_PAYMENT": ("mean", "sum"),
}
POS_LEVEL1 = {
    "MONTHS_BALANCE": ("max", "mean", "size"),
    "SK_DPD": ("max", "mean"),
    "SK_DPD_DEF": ("max", "mean"),
    "CNT_INSTALMENT_FUTURE": ("max",),
}
INSTALMENT_LEVEL1 = {
    "NUM_INSTALMENT_VERSION": ("nunique",),
    "DPD": ("max", "mean", "sum"),
    "DBD": ("max", "mean", "sum"),
    "PAYMENT_PERC": ("mean", "sum", "var"),
    "PAYMENT_DIFF": ("mean", "sum", "var"),
    "AMT_INSTALMENT": ("max", "mean", "sum"),
    "AMT_PAYMENT": ("min", "max", "mean", "sum"),
    "DAYS_ENTRY_PAYMENT": ("max", "mean", "sum"),
}

# The date columns of previous applications that use the sentinel.
PREVIOUS_DATES = (
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
)

EXT = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
BINARY = ("CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY")
EDUCATION = "NAME_EDUCATION_TYPE"


def level2_spec(level1: Mapping[str, Sequence[str]]) -> dict[str, Sequence[str]]:
    """Level 2 uses the same columns with all six functions."""
    return {c: ("nunique", "count") if "nunique" in fns else ALL6 for c, fns in level1.items()}


@dataclass(frozen=True)
class CreditTables:
    application_train: DataFrame
    application_test: DataFrame
    bureau: DataFrame
    bureau_balance: DataFrame
    previous_application: DataFrame
    pos_cash_balance: DataFrame
    installments_payments: DataFrame
    credit_card_balance: DataFrame


# File names of the eight inputs.
FILES = {
    "application_train": "application_train",
    "application_test": "application_test",
    "bureau": "bureau",
    "bureau_balance": "bureau_balance",
    "previous_application": "previous_application",
    "pos_cash_balance": "POS_CASH_balance",
    "installments_payments": "installments_payments",
    "credit_card_balance": "credit_card_balance",
}


def load_tables(
    spark: SparkSession,
    folder: str,
    fmt: str = "parquet",
    schemas: Mapping[str, str] | None = None,
    rows: int | None = None,
) -> CreditTables:
    """The eight inputs from a folder of Parquet or CSV files; ``rows`` caps each for debugging."""
    schemas = schemas or {}
    loaded = {}
    for name, file in FILES.items():
        if fmt == "csv":
            loaded[name] = read_csv(spark, f"{folder}/{file}.csv", schemas.get(name), rows)
        else:
            df = nan_to_null(spark.read.parquet(f"{folder}/{file}.parquet"))
            loaded[name] = df.limit(rows) if rows else df
    return CreditTables(**loaded)


def stage_inputs(spark: SparkSession, folder: str, schemas: Mapping[str, str], out: str) -> CreditTables:
    """Unpack the zipped CSV inputs to Parquet once, then load them."""
    for name, file in FILES.items():
        stage_zip(spark, f"{folder}/{file}.csv.zip", schemas[name], f"{out}/{file}.parquet")
    return load_tables(spark, out)


# --- entity table -----------------------------------------------------------


def application_features(tables: CreditTables, bins: int = 0, fit_on: str = "all") -> DataFrame:
    """Row features of train and test applications.

    ``bins`` adds quantile bins of the external scores (level 2 uses 100).
    ``fit_on='train'`` takes medians, minima and group statistics from labelled
    rows only; the default uses both parts, as the original jobs do.
    """
    df = tables.application_train.unionByName(tables.application_test, allowMissingColumns=True)
    df = nan_to_null(df).where(is_not("CODE_GENDER", "XNA"))
    docs, contacts = assemble.document_flags(df), assemble.contact_flags(df)
    df = df.withColumn("DAYS_EMPLOYED", sentinel_to_null("DAYS_EMPLOYED"))
    # Everything fitted reads this early frame, so each fit scans only its own columns.
    everyone = df
    fitted = df.where(F.col(LABEL).isNotNull()) if fit_on == "train" else df

    if bins:
        codes = {c: f"{c}p" for c in EXT}
        df = encode.quantile_bin(df, codes, bins, encode.quantile_edges(fitted, list(EXT), bins))
        df = df.withColumn("EXT_SOURCE_3pm", row_mean(list(codes.values())))
    medians = _medians(fitted, EXT)
    imputed = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))) for c in EXT}
    df = df.withColumns(imputed)

    df = df.withColumns(
        {
            "NEW_CREDIT_TO_ANNUITY_RATIO": ratio("AMT_CREDIT", "AMT_ANNUITY"),
            "NEW_CREDIT_TO_GOODS_RATIO": ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
            "NEW_INC_PER_CHLD": ratio("AMT_INCOME_TOTAL", 1 + F.col("CNT_CHILDREN")),
            "NEW_EMPLOY_TO_BIRTH_RATIO": shifted_ratio(fitted, "DAYS_EMPLOYED", "DAYS_BIRTH"),
            "NEW_ANNUITY_TO_INCOME_RATIO": ratio("AMT_ANNUITY", 1 + F.col("AMT_INCOME_TOTAL")),
            "NEW_SOURCES_PROD": product(*EXT),
            "NEW_EXT_SOURCES_MEAN": row_mean(list(EXT)),
            "NEW_CAR_TO_BIRTH_RATIO": shifted_ratio(fitted, "OWN_CAR_AGE", "DAYS_BIRTH"),
            "NEW_CAR_TO_EMPLOY_RATIO": shifted_ratio(fitted, "OWN_CAR_AGE", "DAYS_EMPLOYED"),
            # The phone ratio ends up on the employment denominator.
            "NEW_PHONE_TO_BIRTH_RATIO": shifted_ratio(fitted, "DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
            "NEW_CREDIT_TO_INCOME_RATIO": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
            "NEW_CREDIT_TO_ANNUITY_RATIO_GOODS_PRICE": ratio(
                "AMT_CREDIT", F.col("AMT_ANNUITY") + F.col("AMT_GOODS_PRICE")
            ),
        }
    )
    if docs:
        df = with_row_kurtosis(df, docs, "NEW_DOC_IND_KURT")
    if contacts:
        df = df.withColumn("NEW_LIVE_IND_SUM", row_sum(contacts))
    df = with_row_std(df, list(EXT), "NEW_SCORES_STD")
    mean_std = global_value(with_row_std(fitted.withColumns(imputed), list(EXT), "s"), F.avg("s"))
    df = df.withColumn("NEW_SCORES_STD", F.coalesce("NEW_SCORES_STD", mean_std))
    df = lookup.group_median(df, "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", "NEW_INC_BY_ORG", fitted)

    amounts = ("AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE")
    once = {c: safe_log10(c) for c in amounts}
    df, logged = df.withColumns(once), fitted.withColumns(once)
    df = lookup.group_stats(df, [*BINARY, EDUCATION], ["AMT_ANNUITY"], logged)
    df = lookup.group_stats(df, list(BINARY), ["AMT_CREDIT", "AMT_GOODS_PRICE"], logged)
    # A second logarithm replaces the first once the group statistics are taken.
    df = df.withColumns({c: safe_log10(c) for c in amounts})
    df = with_joint_ratios(df, fitted)
    # Every string column is one of the inputs, so vocabularies come from there.
    strings = encode.string_columns(fitted)
    vocab = encode.vocabulary(everyone, strings)
    df = encode.ordinal_encode(df, list(BINARY), vocab)
    return encode.one_hot(df, [c for c in strings if c not in BINARY], False, vocab)[0]


def _medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    stacked = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in columns]))
    )
    return {r["c"]: r["q"] for r in exact_quantiles(stacked, "x", 2, ["c"], only=[1]).collect()}


# --- history blocks ---------------------------------------------------------


def _block(
    df: DataFrame,
    spec: Mapping[str, Sequence[str]],
    shares: Sequence[str],
    windows: Windows,
    slices: Slices | None,
    source: str,
    prefix: str = "",
    size: str | None = None,
    means: Sequence[str] = (),
    keep: Keep = None,
) -> DataFrame:
    """Windowed block in wide form; category shares belong to the unsliced part only.

    ``keep`` drops features by final name before they are aggregated.
    """
    whole = {**spec, **{c: ("share",) for c in shares}, **{c: ("mean",) for c in means}}
    long = windowed_agg(df, KEY, whole, windows, slices, prefix, size)
    names = list(slices.names) if slices else [""]
    everyone = names[0]
    categories = {f"{c}_MEAN" for c in (*shares, *means)}

    def name(window: str, slice_: str, feature: str) -> str:
        middle = f"{slice_}_" if slice_ else ""
        return f"{window}_{source}_{middle}{feature}"

    unwanted = {name(w, s, f) for w in windows.labels() for s in names if s != everyone for f in categories}
    return spread(
        long, KEY, windows.labels(), names, name, keep=lambda n: n not in unwanted and (keep is None or keep(n))
    )


def bureau_block(
    bureau: DataFrame,
    balance: DataFrame,
    days: tuple[int, ...],
    unlimited: bool,
    spec=BUREAU_LEVEL1,
    keep: Keep = None,
) -> DataFrame:
    """Credit-bureau history with the monthly balance rolled up per credit."""
    months, months_new = encode.one_hot(balance)
    rolled = child_rollup(months, "SK_ID_BUREAU", "MONTHS_BALANCE", months_new)
    wide, shares = encode.one_hot(bureau.withColumn("__status", F.col("CREDIT_ACTIVE")), encode.string_columns(bureau))
    joined = wide.join(rolled, "SK_ID_BUREAU", "left").drop("SK_ID_BUREAU")
    slices = Slices("__status", {"BURO": None, "ACTIVE": "Active", "CLOSED": "Closed"})
    return _block(
        joined, spec, shares, Windows("DAYS_CREDIT", days, unlimited), slices, "bb",
        means=[f"{c}_MEAN" for c in months_new], keep=keep,
    )


def previous_block(
    previous: DataFrame, days: tuple[int, ...], unlimited: bool, spec=PREVIOUS_LEVEL1, keep: Keep = None
) -> DataFrame:
    """Previous applications; a window needs a first due date younger than its limit."""
    df = previous.withColumns({c: sentinel_to_null(c, MISSING_DATE) for c in PREVIOUS_DATES if c in previous.columns})
    df = df.withColumns(
        {"APP_CREDIT_PERC": ratio("AMT_APPLICATION", "AMT_CREDIT"), "__status": F.col("NAME_CONTRACT_STATUS")}
    )
    wide, shares = encode.one_hot(df, encode.string_columns(previous))
    slices = Slices("__status", {"PREV": None, "APPROVED": "Approved", "REFUSED": "Refused"})
    return _block(wide, spec, shares, Windows("DAYS_FIRST_DUE", days, unlimited, strict=True), slices, "prevapp", keep=keep)


def pos_block(
    pos: DataFrame, months: tuple[int, ...], unlimited: bool, spec=POS_LEVEL1, keep: Keep = None
) -> DataFrame:
    wide, shares = encode.one_hot(pos)
    return _block(
        wide, spec, shares, Windows("MONTHS_BALANCE", months, unlimited), None, "poscash", "POS_", "POS_COUNT", keep=keep
    )


def instalment_block(
    payments: DataFrame, days: tuple[int, ...], unlimited: bool, spec=INSTALMENT_LEVEL1, keep: Keep = None
) -> DataFrame:
    made = payment_features("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")
    wide, shares = encode.one_hot(payments.withColumns(made))
    return _block(
        wide, spec, shares, Windows("DAYS_INSTALMENT", days, unlimited), None, "instpay", "INSTAL_", "INSTAL_COUNT", keep=keep
    )


def card_block(card: DataFrame, months: tuple[int, ...], unlimited: bool, keep: Keep = None) -> DataFrame:
    """Every remaining numeric column and indicator with the five blanket functions."""
    wide, _ = encode.one_hot(card.drop("SK_ID_PREV"))
    spec = blanket_spec(wide, [KEY], BLANKET5)
    return _block(
        wide, spec, (), Windows("MONTHS_BALANCE", months, unlimited), None, "credditcard", "CC_", "CC_COUNT", keep=keep
    )


def history_blocks(tables: CreditTables, level: int, keep: Keep = None) -> list[DataFrame]:
    """The five blocks: level 1 with all windows, level 2 with one window each."""
    days, months = (LEVEL1_DAYS, LEVEL1_MONTHS) if level == 1 else (LEVEL2_DAYS, LEVEL2_MONTHS)
    unlimited = level == 1
    spec = (lambda s: s) if level == 1 else level2_spec
    blocks = [
        bureau_block(tables.bureau, tables.bureau_balance, days, unlimited, spec(BUREAU_LEVEL1), keep),
        previous_block(tables.previous_application, days, unlimited, spec(PREVIOUS_LEVEL1), keep),
        pos_block(tables.pos_cash_balance, months, unlimited, spec(POS_LEVEL1), keep),
        instalment_block(tables.installments_payments, days, unlimited, spec(INSTALMENT_LEVEL1), keep),
        card_block(tables.credit_card_balance, months, unlimited, keep),
    ]
    return [b for b in blocks if len(b.columns) > 1]


# --- feature tables ---------------------------------------------------------


def with_joint_ratios(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Ratios of columns moved by their minimum over ``fitted``."""
    birth, registered, employed, published = (
        shifted(fitted, c) for c in ("DAYS_BIRTH", "DAYS_REGISTRATION", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH")
    )
    return df.withColumns(
        {
            "f_12": ratio("AMT_GOODS_PRICE", "AMT_ANNUITY"),
            "f_13": ratio("AMT_GOODS_PRICE", "DAYS_EMPLOYED"),
            "f_15": ratio(birth, registered),
            "f_16": ratio(registered, employed),
            "f_17": ratio(birth, published),
        }
    )


def with_level2_ratios(df: DataFrame) -> DataFrame:
    df = df.withColumns(
        {
            "f70": ratio("DEF_60_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"),
            "f71": ratio("DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE"),
        }
    )
    return df.withColumns(
        {
            "f76": product("f70", "f71"),
            "f72": ratio("NEW_CREDIT_TO_ANNUITY_RATIO", "CODE_GENDER"),
            "f73": ratio("NEW_CREDIT_TO_ANNUITY_RATIO", "REGION_RATING_CLIENT_W_CITY"),
            "f74": ratio("DAYS_BIRTH", "EXT_SOURCE_1"),
            "f75": ratio("NEW_CREDIT_TO_ANNUITY_RATIO", "DEF_30_CNT_SOCIAL_CIRCLE"),
            "f88": ratio("NEW_CREDIT_TO_ANNUITY_RATIO", "f71"),
        }
    )


def level1_matrix(
    tables: CreditTables,
    blacklist: Sequence[str] = (),
    prior_importance: DataFrame | None = None,
    threshold: float = 10.0,
    fit_on: str = "all",
) -> DataFrame:
    """Entity features, 25 windowed blocks in five joins, pruned columns.

    The blacklist and the prior importances are applied before the blocks are
    aggregated, so a dropped feature costs nothing.
    """
    doomed = assemble.blacklisted(blacklist)
    chosen = None
    if prior_importance is not None:
        rows = prior_importance.where(F.col("importance") > threshold).select("feature").collect()
        chosen = {r["feature"] for r in rows}

    def keep(name: str) -> bool:
        return name not in doomed and (chosen is None or name in chosen)

    entity = application_features(tables, fit_on=fit_on)
    df = assemble.drop_blacklist(entity, blacklist)
    if chosen is not None:
        df = assemble.keep_features(df, [c for c in df.columns if c in chosen], [KEY, LABEL])
    return assemble.feature_matrix(df, KEY, history_blocks(tables, 1, keep))


def level2_matrix(
    tables: CreditTables,
    predictions: DataFrame | None = None,
    models: Sequence[str] = (),
    fit_on: str = "all",
    narrow: bool = False,
) -> DataFrame:
    """Entity features with score bins, one window per table, stacked predictions."""
    entity = with_level2_ratios(application_features(tables, bins=100, fit_on=fit_on))
    blocks = history_blocks(tables, 2)
    if narrow:
        entity, blocks = encode.narrow_types(entity), [encode.narrow_types(b) for b in blocks]
    df = assemble.feature_matrix(entity, KEY, blocks)
    if predictions is not None:
        df = assemble.stack_features(df, KEY, predictions, models)
    return assemble.keep_features(df, assemble.feature_columns(df), [KEY, LABEL])


# --- training and selection -------------------------------------------------


def train_models(
    matrix: DataFrame,
    presets: Sequence[boosting.Preset] = (boosting.LEAFWISE, boosting.DEPTHWISE, boosting.SYMMETRIC),
    folds: int = 5,
    out: str | None = None,
    run: str = "level1",
    early_stopping: bool = True,
) -> dict[str, boosting.CrossValidation]:
    """Out-of-fold runs of every preset; ``out`` also writes scores, importances and metrics."""
    features = assemble.feature_columns(matrix)
    done = {}
    for preset in presets:
        cv = boosting.cross_validate(matrix, KEY, LABEL, features, preset, folds, early_stopping=early_stopping)
        done[preset.name] = cv
        if out:
            sinks.write_submission(cv.test, KEY, f"{out}/{run}/submission_{preset.name}")
            sinks.write_oof(cv.oof, f"{out}/{run}/oof_{preset.name}")
            # Split counts are what the pruning threshold and the selection step read; gain shares are there besides.
            for kind, table in (("fimp", cv.splits), ("gain", cv.importance)):
                sinks.write_mean_importance(table, f"{out}/{run}/{kind}_{preset.name}")
                sinks.write_table(importance.to_wide(table, folds), f"{out}/{run}/{kind}_folds_{preset.name}")
            sinks.append_metrics(boosting.auc_log(run, cv.oof), f"{out}/{run}/metrics")
    return done


def null_importances(
    matrix: DataFrame,
    preset: boosting.Preset = boosting.LEAFWISE,
    folds: int = 12,
    permutations: int = 1,
    seed: int = 1001,
    kind: str = "splits",
    **options,
) -> DataFrame:
    """Importances ``(run, feature, fold, importance)`` on real and permuted labels.

    ``kind`` is ``splits`` (how often a feature splits) or ``gain`` (its share of the gain). All permutations are trained together: a row
    carries an array of labels, and one pass over the binned rows serves every label and fold.
    """
    if kind not in ("splits", "gain"):
        raise ValueError(f"kind is splits or gain, not {kind!r}")
    features = assemble.feature_columns(matrix)
    table = materialize(matrix, "selection")
    mixed = selection.permute_labels(table.select(KEY, LABEL), KEY, LABEL, [seed + p for p in range(permutations)])
    labels = [f"__null{p}" for p in range(permutations)]
    joined = table.join(mixed.select(KEY, *[F.col("labels")[p].alias(c) for p, c in enumerate(labels)]), KEY, "left")
    cv = boosting.cross_validate(joined, KEY, [LABEL, *labels], features, preset, folds, **options)
    found = cv.splits if kind == "splits" else cv.importance
    return found.select(
        F.when(F.col("run") == 0, "actual").otherwise("null").alias("run"),
        "feature",
        (F.col("fold") + F.greatest(F.col("run") - 1, F.lit(0)) * folds).cast("int").alias("fold"),
        "importance",
    )


def select_by_null_importance(
    matrix: DataFrame, importances: DataFrame, alpha: float = 0.05, require_gain: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The matrix reduced to selected features, and the full test table."""
    tested = selection.importance_ttest(importances)
    picked = selection.select_features(tested, alpha, require_gain).select("feature").collect()
    kept = assemble.keep_features(matrix, [r["feature"] for r in picked], [KEY, LABEL])
    return kept, tested


def quick(preset: boosting.Preset, rounds: int, depth: int | None = None, step: float = 0.1) -> boosting.Preset:
    """A preset cut to a given number of trees, for trials."""
    return replace(preset, rounds=rounds, depth=depth or preset.depth, step=step, min_child_weight=min(preset.min_child_weight, 5.0))
