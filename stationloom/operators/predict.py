"""Precipitation models fitted and scored as aggregates, one model per station.

A model is a table with one row per station. Fits are single aggregates with
partial sums per task; scoring attaches the model row to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationloom.operators.correlation import pearson
from stationloom.operators.reshape import feature_pivot
from stationloom.operators.select import (
    ALL_OFFSETS,
    drop_invalid_values,
    element_values,
    filter_elements,
    filter_series,
    keep_min_offset,
)
from stationloom.operators.attach import attach
from stationloom.plans.materialise import materialise
from stationloom.schema import (
    ELEMENT,
    MAX_TEMPERATURE,
    MIN_TEMPERATURE,
    PRECIPITATION,
    SOURCE,
    TIME,
    VALUE,
)

FEATURES = {MAX_TEMPERATURE: "TMAX", MIN_TEMPERATURE: "TMIN"}


def _valid_feature_rows(df: DataFrame, elements: list[str], source_id: str | None) -> DataFrame:
    """Numeric rows of some elements, each at its smallest offset holding a number."""
    chosen = filter_elements(filter_series(df, source_id=source_id), elements)
    return keep_min_offset(drop_invalid_values(chosen))


def weather_features(df: DataFrame, source_id: str | None = None) -> DataFrame:
    """Station x instant with ``TMAX, TMIN, RAIN``; all three must be present.

    One aggregate instead of two joins; a station with two values for one
    element and instant is an error.
    """
    names = {**FEATURES, PRECIPITATION: "RAIN"}
    rows = _valid_feature_rows(df, list(names), source_id)
    cells = {n: F.when(F.col(ELEMENT) == e, F.col(VALUE)) for e, n in names.items()}
    repeated = F.greatest(*[F.count(c) for c in cells.values()]) > 1
    return rows.groupBy(SOURCE, TIME).agg(
        *[F.when(repeated, F.raise_error(F.lit("repeated observation")))
          .otherwise(F.max(c)).alias(n) for n, c in cells.items()]
    ).dropna(subset=list(names.values()))


def precipitation_features(df: DataFrame, source_id: str | None = None) -> DataFrame:
    """Station x date with mean ``TMAX, TMIN, PRCP``; all three must be present."""
    names = {**FEATURES, PRECIPITATION: "PRCP"}
    rows = _valid_feature_rows(df, list(names), source_id)
    return feature_pivot(rows, names)


def rain_label(features: DataFrame, column: str = "RAIN") -> DataFrame:
    """Set ``label`` to 1 where it rained, else 0."""
    return features.withColumn(
        "label", F.when(F.col(column) > 0, 1).otherwise(0)
    )


def train_test_split(df: DataFrame, key: Column, train_percent: int = 80) -> DataFrame:
    """Add ``is_train`` from a hash of ``key``: repeatable, no shuffle, no seed state."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10)
    bucket = F.pmod(head.cast("bigint"), F.lit(100))
    return df.withColumn("is_train", bucket < train_percent)


# Leading bits of a 60-bit hash that the first histogram of an exact split tells apart.
_SPLIT_BITS = 16


def exact_train_test_split(df: DataFrame, key: Column, train_percent: int = 80) -> DataFrame:
    """Add ``is_train``; of each station's n rows exactly ``n * train_percent // 100`` are for training.

    Training takes the rows of the least hashes of ``key``, so the split is repeatable. Rows of one
    key stay on one side; where keys repeat, training takes as many as fit. A null key is an
    empty text; rows without a station are a group. The border of a station is found in two
    histograms: counts by the leading bits of the hash say where it lies, and the distinct hashes
    there say what it is. ``df`` is read three times.
    """
    if not 0 <= train_percent <= 100:
        raise ValueError("train_percent must be between 0 and 100")
    head = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10)
    hashed = df.withColumn("__hash", head.cast("bigint"))
    part = F.shiftright("__hash", 60 - _SPLIT_BITS)
    coarse = hashed.groupBy(SOURCE, part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(SOURCE)
    upto = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    running = coarse.select(
        SOURCE, "__part", F.sum("__n").over(upto).alias("__upto"), "__n",
        F.floor(F.sum("__n").over(whole) * train_percent / 100).alias("__target"))
    # the first part that holds more than is wanted; none where all rows are for training
    borders = running.where(F.col("__upto") > F.col("__target")).groupBy(SOURCE).agg(
        F.min("__part").alias("__part"), F.min_by(F.col("__target") - F.col("__upto") + F.col("__n"), "__part").alias("__left"))
    near = attach(hashed.select(SOURCE, "__hash"), borders.withColumnRenamed("__part", "__at"), [SOURCE], ["__at", "__left"], how="inner")
    fine = near.where(part == F.col("__at")).groupBy(SOURCE, "__hash").agg(
        F.count(F.lit(1)).alias("__n"), F.first("__left").alias("__left"), F.first("__at").alias("__at"))
    order = whole.orderBy("__hash").rowsBetween(Window.unboundedPreceding, 0)
    taken = fine.withColumn("__fits", F.sum("__n").over(order) <= F.col("__left"))
    last = taken.groupBy(SOURCE).agg(F.coalesce(
        F.max(F.when(F.col("__fits"), F.col("__hash"))), F.shiftleft(F.first("__at"), 60 - _SPLIT_BITS) - 1).alias("__last"))
    split = attach(hashed, last, [SOURCE], ["__last"])
    return split.withColumn("is_train", F.coalesce(F.col("__hash") <= F.col("__last"), F.lit(True))).drop("__hash", "__last")


def split_key(time: str = TIME) -> Column:
    """Station and day as text, the key used for splitting."""
    return F.concat_ws("|", F.col(SOURCE), F.date_format(time, "yyyy-MM-dd"))


def standard_scale(df: DataFrame, columns: tuple[str, ...] = ("TMAX", "TMIN")) -> DataFrame:
    """Add ``<column>_z`` from each station's training mean and population std.

    A constant column is centred only.
    """
    train = {c: F.when(F.col("is_train"), F.col(c)) for c in columns}
    scale = df.groupBy(SOURCE).agg(
        *[F.avg(v).alias(f"{c}_mean") for c, v in train.items()],
        *[F.stddev_pop(v).alias(f"{c}_std") for c, v in train.items()],
    )
    added = [f"{c}_{part}" for c in columns for part in ("mean", "std")]
    joined = attach(df, scale, [SOURCE], added)
    spread = {c: F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std"))
              for c in columns}
    return joined.withColumns({
        f"{c}_z": (F.col(c) - F.col(f"{c}_mean")) / spread[c] for c in columns
    }).drop(*added)


# Newton steps of the logistic fit; it starts from zero and is near its optimum after five.
NEWTON_STEPS = 8

_WEIGHTS = ["w0", "w1", "w2"]


def fit_rain_logistic(scaled: DataFrame, c: float = 1.0, steps: int = NEWTON_STEPS,
                      columns: tuple[str, str] = ("TMAX_z", "TMIN_z")) -> DataFrame:
    """L2 logistic regression of every station: ``sourceId, n, w0, w1, w2``.

    ``w0`` is the intercept, which carries no penalty; ``c`` is the inverse strength
    relative to the summed loss. Each Newton step is one aggregate of slopes and
    curvatures per station and a closed solution of three equations. A station whose
    curvature vanishes keeps null weights.
    """
    x = [F.lit(1.0), F.col(columns[0]), F.col(columns[1])]
    train = materialise(scaled.where("is_train").select(SOURCE, "label", *columns))
    model = train.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("n"), *[F.lit(0.0).alias(w) for w in _WEIGHTS])
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    for _ in range(steps):
        rows = attach(train, model, [SOURCE], ["n", *_WEIGHTS])
        chance = 1 / (1 + F.exp(-(F.col("w0") + F.col("w1") * x[1] + F.col("w2") * x[2])))
        rows = rows.withColumn("p", chance)
        curve = F.col("p") * (1 - F.col("p"))
        sums = rows.groupBy(SOURCE, "n", *_WEIGHTS).agg(
            *[F.sum((F.col("p") - F.col("label")) * x[i]).alias(f"g{i}") for i in range(3)],
            *[F.sum(curve * x[i] * x[j]).alias(f"h{i}{j}") for i, j in pairs],
        )
        slope = [F.col(f"g{i}") + (F.col(f"w{i}") / c if i else 0) for i in range(3)]
        h = {(i, j): F.col(f"h{i}{j}") + (1 / c if i == j and i else 0) for i, j in pairs}
        h |= {(j, i): v for (i, j), v in h.items()}
        moved = _solve(h, slope)
        model = sums.select(
            SOURCE, "n", *[(F.col(w) - m).alias(w) for w, m in zip(_WEIGHTS, moved)])
    return model


def _solve(h: dict, g: list[Column]) -> list[Column]:
    """Three linear equations by Cramer's rule."""
    def det(m) -> Column:
        return (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
                - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
                + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))

    whole = F.nullif(det([[h[i, j] for j in range(3)] for i in range(3)]), F.lit(0.0))
    return [
        det([[g[i] if j == k else h[i, j] for j in range(3)] for i in range(3)]) / whole
        for k in range(3)
    ]


def predict_rain_logistic(model: DataFrame, scaled: DataFrame,
                          columns: tuple[str, str] = ("TMAX_z", "TMIN_z")) -> DataFrame:
    """Add the 0/1 ``prediction`` of each station's :func:`fit_rain_logistic`."""
    joined = attach(scaled, model, [SOURCE], _WEIGHTS)
    score = F.col("w0") + F.col("w1") * F.col(columns[0]) + F.col("w2") * F.col(columns[1])
    return joined.withColumn(
        "prediction", F.when(score.isNotNull(), F.when(score > 0, 1).otherwise(0))
    ).drop(*_WEIGHTS)


# Fixed value: share of the largest feature variance added to every variance.
NB_SMOOTHING = 1e-9


def fit_rain_gaussian_nb(scaled: DataFrame,
                         columns: tuple[str, ...] = ("TMAX_z", "TMIN_z")) -> DataFrame:
    """Gaussian naive Bayes per station: class priors, means and variances."""
    train = scaled.where("is_train")
    label = F.col("label")
    measures = [F.count(F.lit(1)).alias("n")]
    for k in (0, 1):
        measures.append((F.count_if(label == k) / F.count(F.lit(1))).alias(f"prior_{k}"))
        for col in columns:
            v = F.when(label == k, F.col(col))
            measures.append(F.avg(v).alias(f"mean_{k}_{col}"))
            measures.append(F.var_pop(v).alias(f"var_{k}_{col}"))
    smoothing = F.greatest(*[F.var_pop(col) for col in columns]) * NB_SMOOTHING
    fitted = train.groupBy(SOURCE).agg(*measures, smoothing.alias("smoothing"))
    return fitted.withColumns({
        f"var_{k}_{col}": F.col(f"var_{k}_{col}") + F.col("smoothing")
        for k in (0, 1) for col in columns
    }).drop("smoothing")


def predict_rain_gaussian_nb(model: DataFrame, scaled: DataFrame,
                             columns: tuple[str, ...] = ("TMAX_z", "TMIN_z")) -> DataFrame:
    """Add the 0/1 ``prediction`` of :func:`fit_rain_gaussian_nb`.

    Where no column varied in training, the classes differ by their priors alone.
    """
    parts = [c for c in model.columns if c not in (SOURCE, "n")]
    joined = attach(scaled, model, [SOURCE], parts)

    def log_likelihood(k: int) -> Column:
        total = F.ln(f"prior_{k}")
        for col in columns:
            mean, var = F.col(f"mean_{k}_{col}"), F.col(f"var_{k}_{col}")
            spread = F.nullif(var, F.lit(0.0))
            squares = (F.col(col) - mean) * (F.col(col) - mean)
            total = total - F.when(var == 0, 0.0).otherwise(
                0.5 * F.ln(2 * F.pi() * spread) + squares / (2 * spread))
        return total

    one, zero = log_likelihood(1), log_likelihood(0)
    # A class absent from training has no likelihood and is never predicted.
    prediction = (
        F.when(zero.isNull() & one.isNull(), F.lit(None).cast("int"))
        .when(zero.isNull(), 1).when(one.isNull(), 0)
        .when(one > zero, 1).otherwise(0)
    )
    return joined.withColumn("prediction", prediction).drop(*parts)


# Share of the product of two variances below which their determinant is rounding error.
COLLINEAR = 1e-12


def fit_precipitation_linear(split: DataFrame, target: str = "PRCP") -> DataFrame:
    """Least squares ``target ~ TMAX + TMIN`` per station from one aggregate.

    Where columns are constant or collinear in training, of all solutions the one of the
    least coefficients: a constant column has the coefficient 0.
    """
    train = split.where("is_train")
    moments = train.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("TMAX").alias("mx"), F.avg("TMIN").alias("mn"), F.avg(target).alias("my"),
        F.var_pop("TMAX").alias("sxx"), F.var_pop("TMIN").alias("snn"),
        F.covar_pop("TMAX", "TMIN").alias("sxn"),
        F.covar_pop("TMAX", target).alias("sxy"),
        F.covar_pop("TMIN", target).alias("sny"),
    )
    whole = F.col("sxx") * F.col("snn")
    det = whole - F.col("sxn") * F.col("sxn")
    # Of one direction only, or of none: the pseudoinverse is that of the trace.
    trace = F.nullif(F.col("sxx") + F.col("snn"), F.lit(0.0))

    def solved(full: Column, single: Column) -> Column:
        return F.when(det > COLLINEAR * whole, full / F.nullif(det, F.lit(0.0))).otherwise(
            F.coalesce(single / trace, F.lit(0.0)))

    b_max = solved(F.col("sxy") * F.col("snn") - F.col("sny") * F.col("sxn"), F.col("sxy"))
    b_min = solved(F.col("sny") * F.col("sxx") - F.col("sxy") * F.col("sxn"), F.col("sny"))
    return moments.withColumns({"coef_tmax": b_max, "coef_tmin": b_min}).withColumn(
        "intercept",
        F.col("my") - F.col("coef_tmax") * F.col("mx") - F.col("coef_tmin") * F.col("mn"),
    ).select(SOURCE, "n", "coef_tmax", "coef_tmin", "intercept")


def predict_precipitation(model: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``predicted`` millimetres and ``will_rain`` to rows with TMAX, TMIN.

    Rows carry the station whose model scores them.
    """
    parts = ["coef_tmax", "coef_tmin", "intercept"]
    joined = attach(rows, model, [SOURCE], parts)
    return joined.withColumn(
        "predicted",
        F.col("intercept") + F.col("coef_tmax") * F.col("TMAX")
        + F.col("coef_tmin") * F.col("TMIN"),
    ).withColumn("will_rain", F.col("predicted") > 0).drop(*parts)


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Counts by station, label and prediction; all four cells appear."""
    cells = [
        F.struct(
            F.lit(a).alias("label"), F.lit(b).alias("prediction"),
            F.count_if((F.col("label") == a) & (F.col("prediction") == b)).alias("n"),
        )
        for a in (0, 1) for b in (0, 1)
    ]
    return scored.groupBy(SOURCE).agg(F.array(*cells).alias("cells")).select(
        SOURCE, F.inline("cells")
    )


def classification_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per class, plus the overall rows.

    Rows ``0``, ``1``, ``accuracy`` (in ``f1``), ``macro avg``, ``weighted avg``.
    An undefined ratio is 0.
    """
    def cell(a: int, b: int) -> Column:
        return F.sum(F.when((F.col("label") == a) & (F.col("prediction") == b), F.col("n")))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    m = matrix.groupBy(SOURCE).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
        cell(1, 0).alias("fn"), cell(1, 1).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    m = m.withColumns({
        "p0": ratio(tn, tn + fn), "r0": ratio(tn, tn + fp), "s0": tn + fp,
        "p1": ratio(tp, tp + fp), "r1": ratio(tp, tp + fn), "s1": tp + fn,
        "total": tn + fp + fn + tp,
    })
    m = m.withColumns({
        f"f{k}": ratio(2 * F.col(f"p{k}") * F.col(f"r{k}"),
                       F.col(f"p{k}") + F.col(f"r{k}")) for k in (0, 1)
    })

    def row(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
            f.alias("f1"), s.alias("support"),
        )

    def macro(x: str) -> Column:
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2

    def weighted(x: str) -> Column:
        return ratio(
            F.col(f"{x}0") * F.col("s0") + F.col(f"{x}1") * F.col("s1"), F.col("total")
        )

    none = F.lit(None).cast("double")
    rows = [
        row(str(k), F.col(f"p{k}"), F.col(f"r{k}"), F.col(f"f{k}"), F.col(f"s{k}"))
        for k in (0, 1)
    ] + [
        row("accuracy", none, none, ratio(tn + tp, F.col("total")), F.col("total")),
        row("macro avg", macro("p"), macro("r"), macro("f"), F.col("total")),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("total")),
    ]
    return m.select(SOURCE, F.inline(F.array(*rows)))


def regression_metrics(scored: DataFrame, actual: str = "PRCP",
                       predicted: str = "predicted") -> DataFrame:
    """Mean squared error and R² on the test rows per station."""
    test = scored.where(~F.col("is_train"))
    error = F.col(actual) - F.col(predicted)
    mse = F.avg(error * error)
    return test.groupBy(SOURCE).agg(
        mse.alias("mse"),
        (1 - mse / F.nullif(F.var_pop(actual), F.lit(0.0))).alias("r2"),
    )


def actual_vs_predicted(scored: DataFrame, actual: str = "PRCP") -> DataFrame:
    """``TMAX``, actual and predicted value of every test row."""
    return scored.where(~F.col("is_train")).select(
        SOURCE, "date", "TMAX", F.col(actual).alias("actual"), "predicted"
    )


def element_correlation(df: DataFrame, x_element: str, y_element: str,
                        source_id: str | None = None,
                        time_offset: str = ALL_OFFSETS) -> DataFrame:
    """Correlation and linear trend of one element against another per station.

    Values meet at the same station, time and offset.
    """
    rows = filter_elements(
        element_values(df, None, source_id, time_offset), [x_element, y_element]
    )
    pairs = rows.groupBy(SOURCE, "timeOffset", TIME).agg(
        F.max(F.when(F.col(ELEMENT) == x_element, F.col(VALUE))).alias("x"),
        F.max(F.when(F.col(ELEMENT) == y_element, F.col(VALUE))).alias("y"),
    ).dropna(subset=["x", "y"])
    return pairs.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("n"), pearson(F.col("x"), F.col("y")).alias("correlation"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
    )
