"""Recommender: mean baselines, ALS, top-K lists and ranking metrics
(R1-R8, M2-M5, W8, W9, J2-J5).

Ranking metrics never build per-user arrays of relevant items (a user holding
a third of the test set would become one giant row). They are joins and
aggregates over long tables: recommendations (user, item, rank) with at most
K rows per user, and the distinct liked (user, item) pairs. The ideal DCG
needs no ranking at all: with binary gain it is the sum of 1/log2(i+1) for
i = 1..min(n_relevant, K).
"""

from __future__ import annotations

import time

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COLS, DEFAULTS, Cols, checkpoint_dir, release_shuffles
from .evaluate import regression_metrics

REC_TYPE = T.ArrayType(T.StructType([T.StructField(COLS.item, T.IntegerType()),
                                     T.StructField(COLS.rating, T.FloatType())]))


# ------------------------------------------------------------------ baselines

def predict_from_means(test: DataFrame, means: DataFrame, key: str, mean_col: str,
                       drop_cold: bool = True, count_col: str | None = None, c: Cols = COLS,
                       hot_rows: int | None = None) -> DataFrame:
    """LEFT join of test to per-key means; ``drop_cold`` removes rows without
    a mean (keys unseen in training), which makes it an inner join. With the
    means' row counts (``count_col``, default ``<key>_n`` when present) hot
    keys are salted so that no join task receives all test rows of a hot user."""
    from .windows import DEFAULT_HOT_ROWS, salted_join
    count_col = count_col or (f"{key}_n" if f"{key}_n" in means.columns else None)
    if count_col:
        salt = [c.key] if c.key in test.columns else [x for x in test.columns if x != key]
        j = salted_join(test, means, key, count_col, salt, hot_rows=hot_rows or DEFAULT_HOT_ROWS)
    else:
        j = test.join(means, key, "left")
    return j.where(F.col(mean_col).isNotNull()) if drop_cold else j


def baseline_rmse(train: DataFrame, test: DataFrame, c: Cols = COLS) -> DataFrame:
    """RMSE of the global, user-mean and item-mean predictors on test
    (users/items unseen in training dropped). One row per baseline.

    One pass over both sides: grouping sets over user, item and all rows give
    each group the training sum and count and the test count, sum and sum of
    squares; with the training mean m a group's squared error is
    sum(y^2) - 2 m sum(y) + n m^2. No row meets a mean by a join, so a hot user or
    item is reduced in the map tasks.
    """
    side = lambda x, is_train: x.select(c.user, c.item, F.col(c.rating).cast("double").alias("_y"), F.lit(is_train).alias("_t"))
    of = lambda t, x: F.sum(F.when(F.col("_t") == t, x))
    y = F.col("_y")
    g = side(train, True).unionByName(side(test, False)).groupingSets([[c.user], [c.item], []], c.user, c.item).agg(
        F.grouping_id().alias("_g"), of(True, y).alias("_sum"), F.count(F.when(F.col("_t"), y)).alias("_n"),
        of(False, y).alias("_ty"), of(False, y * y).alias("_tyy"), F.count_if(~F.col("_t")).alias("_tn"))
    m = F.col("_sum") / F.col("_n")
    e = g.where("_n > 0 and _tn > 0").select("_g", "_tn", (F.col("_tyy") - 2 * m * F.col("_ty") + F.col("_tn") * m * m).alias("_sse"))
    names = {"global_mean": 3, f"{c.user}_mean": 1, f"{c.item}_mean": 2}       # grouping ids
    one = e.agg(*(f for i, g in enumerate(names.values()) for f in (
        F.sum(F.when(F.col("_g") == g, F.col("_sse"))).alias(f"_sse{i}"), F.sum(F.when(F.col("_g") == g, F.col("_tn"))).alias(f"_n{i}"))))
    return one.select(F.inline(F.array(*(F.struct(
        F.lit(name).alias("baseline"), F.sqrt(F.greatest(F.col(f"_sse{i}"), F.lit(0.0)) / F.col(f"_n{i}")).alias("rmse"),
        F.coalesce(F.col(f"_n{i}"), F.lit(0)).alias("n")) for i, name in enumerate(names)))))


# ------------------------------------------------------------------ ALS

def fit_als(train: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1, seed: int = DEFAULTS.seed,
            c: Cols = COLS, **kw) -> ALSModel:
    """R2: explicit-feedback ALS, cold-start 'drop'. Ids must fit in int.

    ALS checkpoints its factor lineage every ``checkpointInterval`` iterations
    into the session's shared checkpoint folder, so a lost executor does not
    replay all iterations.
    """
    checkpoint_dir(train.sparkSession)
    als = ALS(userCol=c.user, itemCol=c.item, ratingCol=c.rating, rank=rank, maxIter=max_iter, regParam=reg,
              seed=seed, coldStartStrategy="drop", nonnegative=False, implicitPrefs=False, **kw)
    return als.fit(train.select(c.user, c.item, c.rating))


#: Ratings of a block of ALS. A task holds the ratings of one block several times over, and the factors they meet.
BLOCK_RATINGS = 2_000_000


def als_blocks(ratings: int) -> dict:
    """Settings of ``fit_als`` for so many ratings: MLlib's ten blocks up to ten times ``BLOCK_RATINGS``, then as many as
    keep a block at that size. Where there are more than ten, factors are checkpointed every second iteration, which
    deletes the shuffle files of the iterations before."""
    blocks = -(-ratings // BLOCK_RATINGS)
    return {"numUserBlocks": blocks, "numItemBlocks": blocks, "checkpointInterval": 2} if blocks > 10 else {}


def als_regression_metrics(model: ALSModel, test: DataFrame, c: Cols = COLS) -> DataFrame:
    """RMSE, MAE, MSE, R2 on test (cold-start rows dropped by the model)."""
    p = model.transform(test.select(c.user, c.item, c.rating))
    return regression_metrics(p, c.rating, "prediction")


def als_grid(train: DataFrame, test: DataFrame, ranks=(5, 10, 20), iters=(5, 10, 15), regs=(0.01, 0.1, 0.5),
             seed: int = DEFAULTS.seed, c: Cols = COLS, parallelism: int = 1) -> DataFrame:
    """Fit every (rank, maxIter, regParam); RMSE on test and fit+score seconds.

    Train and test are cached around the loop (the reference re-reads them
    for each of its 27 fits) and released afterwards. The blocks of a fit grow in number
    with the ratings, not in size (``als_blocks``). ``parallelism`` > 1
    submits fits from driver threads (like CrossValidator's parallelism). The
    shuffle files of a fit go when it ends, so the disk holds those of the running
    fits only, however many points the grid has.
    """
    spark = train.sparkSession
    tr = train.select(c.user, c.item, c.rating).cache()
    te = test.select(c.user, c.item, c.rating).cache()
    points = [(r, it, reg) for r in ranks for it in iters for reg in regs]
    blocks = als_blocks(tr.count())

    def run(p):
        r, it, reg = p
        t0 = time.time()
        m = fit_als(tr, r, it, reg, seed, c, **blocks)
        rmse = als_regression_metrics(m, te, c).first()["rmse"]
        secs = round(time.time() - t0, 3)
        del m
        release_shuffles(spark)
        return (int(r), int(it), float(reg), float(rmse), secs)

    try:
        if parallelism > 1:
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=parallelism) as ex:
                rows = list(ex.map(run, points))
        else:
            rows = [run(p) for p in points]
    finally:
        tr.unpersist()
        te.unpersist()
    schema = "rank int, max_iter int, reg_param double, rmse double, seconds double"
    return spark.createDataFrame(rows, schema)


def als_ablation(grid: DataFrame) -> DataFrame:
    """Vary one parameter at a time around the best grid point, reusing the
    grid rows instead of refitting (every ablation point lies on the grid)."""
    best = grid.orderBy("rmse", "rank", "max_iter", "reg_param").limit(1).select(
        F.col("rank").alias("_br"), F.col("max_iter").alias("_bi"), F.col("reg_param").alias("_bg"))
    j = grid.crossJoin(F.broadcast(best))  # one-row side
    parts = []
    for name, same in (("rank", (F.col("max_iter") == F.col("_bi")) & (F.col("reg_param") == F.col("_bg"))),
                       ("max_iter", (F.col("rank") == F.col("_br")) & (F.col("reg_param") == F.col("_bg"))),
                       ("reg_param", (F.col("rank") == F.col("_br")) & (F.col("max_iter") == F.col("_bi")))):
        parts.append(j.where(same).select(F.lit(name).alias("varied"), F.col(name).cast("double").alias("value"),
                                          "rank", "max_iter", "reg_param", "rmse", "seconds"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def als_cross_validate(train: DataFrame, test: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                       folds: int = 3, seed: int = DEFAULTS.seed, c: Cols = COLS):
    """K-fold CV at given parameters (hash folds), then the model refit on all of
    train scored on test. Returns (row DataFrame, model). One fold at a time; its
    shuffle files go when it ends."""
    from pyspark.ml.evaluation import RegressionEvaluator

    from .split import check_folds, fold_col

    spark = train.sparkSession
    tr = train.select(c.user, c.item, c.rating, fold_col(c.key, folds).alias("fold")).cache()
    ev = RegressionEvaluator(metricName="rmse", labelCol=c.rating, predictionCol="prediction")

    def fold_rmse(i):
        m = fit_als(tr.where(F.col("fold") != i), rank, max_iter, reg, seed, c, **blocks)
        return float(ev.evaluate(m.transform(tr.where(F.col("fold") == i))))

    try:
        t0 = time.time()
        check_folds(tr, folds)
        blocks = als_blocks(tr.count())
        rmses = []
        for i in range(folds):
            rmses.append(fold_rmse(i))
            release_shuffles(spark)
        cv_rmse = sum(rmses) / folds
        best = fit_als(tr, rank, max_iter, reg, seed, c, **blocks)
        test_rmse = als_regression_metrics(best, test, c).first()["rmse"]
        secs = round(time.time() - t0, 3)
    finally:
        tr.unpersist()
    row = spark.createDataFrame([(rank, max_iter, float(reg), folds, cv_rmse, float(test_rmse), secs)],
                                "rank int, max_iter int, reg_param double, folds int, cv_mean_rmse double, "
                                "test_rmse double, seconds double")
    return row, best


def load_or_fit_als(path: str, train: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                    c: Cols = COLS) -> ALSModel:
    """S9 for the recommender: load the saved ALS model at ``path``, else fit
    with the fallback parameters (rank 10, 10 iterations, reg 0.1) and save it."""
    from ..sources.tables import load_or_fit
    return load_or_fit(ALSModel, path, lambda: fit_als(train, rank, max_iter, reg, c=c))


#: Users of a cell of the factor product; a cell holds four times as many items.
CELL_USERS = 131_072
#: Users and items scored in one product within a cell.
TILE_USERS, TILE_ITEMS = 1024, 512


def recommend_top_k(model: ALSModel, k: int = 10, exclude_seen: DataFrame | None = None,
                    c: Cols = COLS, block: int = CELL_USERS) -> DataFrame:
    """Top-K items for every user, already-rated items included (as the reference), in
    the form of ``recommendForAllUsers``: (user, recommendations array<struct<item, rating>>).

    With ``exclude_seen`` (the training (user, item) pairs) every user gets the K
    best items they have not rated, in long form (user, item, score, rank; ties by
    item id). See ``recommend_unseen``.
    """
    found = recommend_unseen(model.userFactors, model.itemFactors, exclude_seen, k, c, block)
    if exclude_seen is not None:
        return found
    entry = F.struct("rank", F.struct(F.col(c.item), F.col("score").alias(c.rating)).alias("r"))
    return found.groupBy(c.user).agg(F.sort_array(F.collect_list(entry)).getField("r").alias("recommendations"))   # K entries at most


def _cell_search(k: int):
    """The search within a cell, as a function that travels to the executors by value."""
    import numpy as np

    tile_users, tile_items = TILE_USERS, TILE_ITEMS

    def best_of_cell(uid, uf, iid, itf, su, si):
        """The K best items of each user of a cell, but for the pairs (``su``, ``si``): ids of users and items, and
        scores. Ties go to the smaller item id.

        Items are scored in tiles of falling length of their factors. A score is at most
        the product of both lengths, so a user whose K-th best score lies above that
        product needs no later tile. Ids are ascending.
        """
        pu, pi = np.searchsorted(uid, su), np.searchsorted(iid, si)
        known = (pu < len(uid)) & (pi < len(iid))
        known[known] = (uid[pu[known]] == su[known]) & (iid[pi[known]] == si[known])
        size_u, size_i = np.linalg.norm(uf, axis=1), np.linalg.norm(itf, axis=1)
        by = np.argsort(-size_i, kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        iid, itf, size_i = iid[by], itf[by], size_i[by]
        pu, pi = pu[known], place[pi[known]]
        order = np.argsort(pu, kind="stable")
        pu, pi = pu[order], pi[order]
        out = []
        for a in range(0, len(uid), tile_users):
            f, size = uf[a:a + tile_users], size_u[a:a + tile_users]
            n = len(f)
            lo, hi = np.searchsorted(pu, (a, a + n))
            order = np.argsort(pi[lo:hi], kind="stable")
            seen_row, seen_col = pu[lo:hi][order] - a, pi[lo:hi][order]
            live, kth = np.arange(n), np.full(n, -np.inf, np.float32)
            row, col, value = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
            for s in range(0, len(iid), tile_items):
                live = live[(size[live] * size_i[s] * (1 + 1e-9)).astype(np.float32) >= kth[live]]
                if not len(live):
                    break
                score = (f[live] @ itf[s:s + tile_items].T).astype(np.float32)
                lo, hi = np.searchsorted(seen_col, (s, s + tile_items))
                if hi > lo:
                    at = np.full(n, -1)
                    at[live] = np.arange(len(live))
                    r = at[seen_row[lo:hi]]
                    score[r[r >= 0], seen_col[lo:hi][r >= 0] - s] = -np.inf
                least = kth[live]
                if (least == -np.inf).any():
                    at_least = max(0, score.shape[1] - k)
                    least = np.maximum(least, np.partition(score, at_least, axis=1)[:, at_least])
                r, i = np.nonzero((score >= least[:, None]) & (score > -np.inf))      # K per user, and ties with the K-th
                if not len(r):
                    continue
                row, col, value = np.concatenate((row, live[r])), np.concatenate((col, i + s)), np.concatenate((value, score[r, i]))
                order = np.lexsort((iid[col], -value, row))
                row, col, value = row[order], col[order], value[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, col, value = row[keep], col[keep], value[keep]
                full = np.flatnonzero(np.bincount(row, minlength=n) == k)
                kth[full] = value[np.searchsorted(row, full, "right") - 1]
            out.append((uid[a + row], iid[col], value))
        return tuple(np.concatenate(x) for x in zip(*out))

    return best_of_cell


def recommend_unseen(user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame | None, k: int = 10,
                     c: Cols = COLS, block: int = CELL_USERS) -> DataFrame:
    """The K best unseen items per user as a blocked factor product with a bounded merge (``seen`` None: of all items).

    Users are dealt into blocks of about ``block`` rows by a hash of their id (fewer
    where the cluster has more cores than cells), items into blocks of four times
    that; a cell is one user block with one item block. Factors are shuffled once per
    block of the other side, so the large blocks keep that volume low; a cell scores
    tile by tile, so its memory is that of its own rows and one tile. What a user has
    seen is spread over all item blocks. A cell keeps at most K items per user and
    the merge ranks at most K rows per user and item block (cut within each task
    before the shuffle). A user who has seen all but m < K items gets m rows; ids
    outside the model are ignored.
    """
    import numpy as np
    import pyarrow as pa

    n_users, n_items = user_factors.count(), item_factors.count()
    cores = user_factors.sparkSession.sparkContext.defaultParallelism
    n_u = max(1, -(-n_users // block), min(2 * cores, -(-n_users // 2048)))
    n_i = max(1, -(-n_items // (4 * block)))
    deal = lambda col, n: F.pmod(F.xxhash64(F.col(col).cast("int")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("int")
    users = user_factors.select(deal("id", n_u).alias("_ub"), every(n_i).alias("_ib"), F.col("id").alias("_u"), none.alias("_i"), "features")
    items = item_factors.select(every(n_u).alias("_ub"), deal("id", n_i).alias("_ib"), none.alias("_u"), F.col("id").alias("_i"), "features")
    cells = users.unionByName(items)
    if seen is not None:
        cells = cells.unionByName(
            seen.select(F.col(c.user).cast("int").alias("_u"), F.col(c.item).cast("int").alias("_i")).dropna().distinct()
            .select(deal("_u", n_u).alias("_ub"), deal("_i", n_i).alias("_ib"), "_u", "_i", F.lit(None).cast("array<float>").alias("features")))

    def best(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        u, i, f = (cell.column(n).combine_chunks() for n in ("_u", "_i", "features"))
        is_user, is_item = np.asarray(i.is_null()), np.asarray(u.is_null())
        if not is_user.any() or not is_item.any():
            return schema.empty_table()

        def side(mask, ids):
            at = pa.array(np.flatnonzero(mask))
            ids, rows = np.asarray(ids.take(at)), f.take(at).flatten()
            order = np.argsort(ids)
            return ids[order], np.asarray(rows, np.float64).reshape(len(ids), -1)[order]

        at = pa.array(np.flatnonzero(~is_user & ~is_item))
        uid, iid, score = best_of_cell(*side(is_user, u), *side(is_item, i), np.asarray(u.take(at)), np.asarray(i.take(at)))
        return pa.table([pa.array(uid, pa.int32()), pa.array(iid, pa.int32()), pa.array(score, pa.float32())], schema=schema)

    best_of_cell = _cell_search(k)
    schema = pa.schema([(c.user, pa.int32()), (c.item, pa.int32()), ("score", pa.float32())])
    found = cells.groupBy("_ub", "_ib").applyInArrow(best, f"{c.user} int, {c.item} int, score float")
    w = Window.partitionBy(c.user).orderBy(F.desc("score"), F.asc(c.item))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ------------------------------------------------------------------ deterministic recommender

def recommend_popular(train: DataFrame, k: int = 10, c: Cols = COLS) -> DataFrame:
    """Same contract as R6 -- (user, recommendations array<struct<item, rating>>) --
    recommending the k most-rated training items (ties: item id) to every
    training user; the score is the item's rating count.

    The k-item list is one bounded row (k entries) attached to each user.
    """
    pop = train.groupBy(c.item).agg(F.count(F.lit(1)).alias("_n"))
    top = pop.orderBy(F.desc("_n"), F.asc(c.item)).limit(k)
    lst = top.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("_n")).alias("_neg"), F.col(c.item).alias("_i"))), asc=True).alias("_l"))
    recs = F.transform(F.col("_l"), lambda s: F.struct(s["_i"].cast("int").alias(c.item),
                                                       (-s["_neg"]).cast("float").alias(c.rating)))
    users = train.select(c.user).distinct()
    return users.crossJoin(F.broadcast(lst)).select(c.user, recs.alias("recommendations"))  # one-row side


# ------------------------------------------------------------------ ranking metrics

def recs_long(recs: DataFrame, c: Cols = COLS) -> DataFrame:
    """(user, item, score, rank) -- rank = row_number by score desc (tie:
    item id) within the user's list. A list holds at most K rows, so this
    window is bounded per user."""
    x = recs.select(c.user, F.explode("recommendations").alias("_r")).select(
        c.user, F.col(f"_r.{c.item}").alias(c.item), F.col(f"_r.{c.rating}").alias("score"))
    w = Window.partitionBy(c.user).orderBy(F.desc("score"), F.asc(c.item))
    return x.withColumn("rank", F.row_number().over(w))


def relevant_items(test: DataFrame, threshold: float = DEFAULTS.like_threshold, c: Cols = COLS) -> DataFrame:
    """M2 (long form): distinct liked (user, item) pairs of the test set. A pair
    present twice in test counts once (J4 would otherwise fan out)."""
    return test.where(F.col(c.rating) >= threshold).select(c.user, c.item).distinct()


def relevant_counts(rel: DataFrame, c: Cols = COLS) -> DataFrame:
    """M2: liked items per user."""
    return rel.groupBy(c.user).agg(F.count(F.lit(1)).alias("n_relevant"))


def ideal_dcg(n_relevant, k: int):
    """W9 in closed form: sum over i = 1..min(n, k) of 1/log2(i + 1)."""
    n = F.least(n_relevant, F.lit(k))
    ranks = F.when(n >= 1, F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(ranks, F.lit(0.0), lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1))


def ranking_metrics(recs: DataFrame, test: DataFrame, ks=(5, 10), threshold: float = DEFAULTS.like_threshold,
                    digits: int | None = 4, c: Cols = COLS) -> DataFrame:
    """M3-M5 (+J3-J5): per K, mean precision@K (hits/K), recall@K
    (hits/n_relevant) and nDCG@K (binary gain) over users that have both a
    recommendation list and at least one liked test item.
    ``recs`` is a long table (user, item, rank) or an R6/R8 array table."""
    if "recommendations" in recs.columns:
        recs = recs_long(recs, c)
    kmax = max(ks)
    rl = recs.where(F.col("rank") <= kmax).select(c.user, c.item, "rank")
    rel = relevant_items(test, threshold, c)
    hit = rl.join(rel.withColumn("_rel", F.lit(1)), [c.user, c.item], "left")   # J4 (truth de-duplicated)
    per_user = hit.groupBy(c.user).agg(
        *[F.count_if((F.col("rank") <= k) & (F.col("_rel") == 1)).alias(f"_h{k}") for k in ks],
        *[F.sum(F.when((F.col("rank") <= k) & (F.col("_rel") == 1), 1.0 / F.log2(F.col("rank") + 1))
                .otherwise(0.0)).alias(f"_d{k}") for k in ks])
    both = per_user.join(relevant_counts(rel, c), c.user, "inner")               # J3 / J5
    aggs = []
    for k in ks:
        aggs += [F.avg(F.col(f"_h{k}") / F.lit(k)).alias(f"p{k}"),
                 F.avg(F.col(f"_h{k}") / F.col("n_relevant")).alias(f"r{k}"),
                 F.avg(F.col(f"_d{k}") / ideal_dcg(F.col("n_relevant"), k)).alias(f"n{k}")]
    one = both.agg(F.count(F.lit(1)).alias("n_users"), *aggs)
    r = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    rows = F.array(*[F.struct(F.lit(k).alias("k"), r(F.coalesce(F.col(f"p{k}"), F.lit(0.0))).alias("precision_at_k"),
                              r(F.coalesce(F.col(f"r{k}"), F.lit(0.0))).alias("recall_at_k"),
                              r(F.coalesce(F.col(f"n{k}"), F.lit(0.0))).alias("ndcg_at_k"),
                              F.col("n_users").alias("n_users")) for k in ks])
    return one.select(F.inline(rows))
