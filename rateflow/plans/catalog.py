"""Named queries over the driver's parquet tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Entries that
need a written table (splits, co-rating sums, numbered rows) or a small
aggregate run those jobs when called, and ALS entries fit their models.  Every query reads the whole given
tables; the only filters on ids are the ones that define an operator (the
rating distribution of one item, the recommendations of one user).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.operators import als, factors, quality, sampling
from rateflow.operators.aggregates import item_counts, item_stats, user_histories, user_means
from rateflow.operators.evaluate import best_setting, errors, errors_of, mean_over_seeds
from rateflow.operators.file_order import file_order
from rateflow.operators.ordering import number_rows
from rateflow.operators.predict import knn_errors_by_k, predict_mean, predict_user_knn
from rateflow.operators.recommend import (
    attach_titles,
    popular_items,
    recommend_user_knn,
    unrated_items,
)
from rateflow.operators.similarity import (
    aligned_sums,
    co_ratings,
    directed,
    neighbours_for_users,
    top_neighbours,
    user_similarity,
)
from rateflow.session import scratch_path, write_and_read
from rateflow.sources import (
    build_once,
    event_rows,
    import_ratings,
    item_genres,
    parse_item_lines,
    parse_rating_lines,
    tpch_items,
    tpch_items_with_genres,
    tpch_rating_lines,
    tpch_ratings,
    tpch_users,
    write_ratings,
    write_shelves,
)

# Parameters of the registered queries (the library defaults are the full
# grids; see the operator signatures).
ITEM = 1                 # item whose rating distribution is shown
USER = 2                 # user who gets recommendations
SEED = 0                 # split seed of single-seed queries
BASELINE_SEEDS = tuple(range(10))
KNN_SEEDS = tuple(range(10))
K_GRID = tuple(range(30, 201, 10))
K = 200
MIN_COMMON = 10
POPULAR_MIN, POPULAR_N = 100, 30
REC_N = 30
ALS_REG = 0.12
ALS_RANKS = tuple(range(2, 15))
ALS_ITERS = tuple(range(8, 31))
ALS_RANK, ALS_ITER = 4, 20
ALS_SEEDS = tuple(range(10))
ALS_GRID_SEEDS = (0, 1)     # of the grid of ranks; see the README for the time of a fit
SMALL_RANK, SMALL_ITERS = 2, 3
ALS_FINAL_SEED = 9
ALS_MIN_COUNT = 20
SAMPLE_USERS, SAMPLE_ITEMS, SAMPLE_MIN, SAMPLE_SEED = 3000, 10_000, 20, 1   # all ids, if fewer
PREDICT_MIN = 20
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]


def _r(spark, d):
    return tpch_ratings(spark, d)


def _written(spark, d):
    # For queries that read the view several times: its join and dedupe run once.
    return write_and_read(_r(spark, d), "ratings")


def _items(spark, d):
    return tpch_items(spark, d)


def _split(spark, d, seeds):
    # Written once: training, validation and test parts read the same rows.
    return write_and_read(sampling.with_split(_r(spark, d), seeds), "split")


def _part(split, *names):
    return split.filter(F.col("part").isin(*names)).drop("part")


# -- profiling ---------------------------------------------------------------

def q_ratings(spark, d):
    return _r(spark, d)


def q_row_counts(spark, d):
    return quality.row_counts(_r(spark, d), _items(spark, d))


def q_preview(spark, d):
    return quality.preview(_r(spark, d), 3)


def q_rating_distribution(spark, d):
    return quality.rating_distribution(_r(spark, d))


def q_overall_mean(spark, d):
    return quality.overall_mean(quality.rating_distribution(_r(spark, d)))


def _spoilt_lines(spark, d):
    """``user_id, item_id, value``: the rating view as text lines; five in eleven
    are spoilt by the ids."""
    u, i = F.col("user_id"), F.col("item_id")
    # The texts of "%d" and "%.1f", which are slow: half stars below a million look alike as casts.
    plain = (F.abs("rating") < 1e6) & (F.col("rating") * 2 == F.rint(F.col("rating") * 2))
    user, item = (F.coalesce(x.cast("string"), F.lit("null")) for x in (u, i))
    good = F.concat_ws(",", user, item, F.when(plain, F.col("rating").cast("string")).otherwise(F.format_string("%.1f", "rating")))
    which = (u * 31 + i) % 11
    spoilt = [user, F.concat(user, F.lit(",x,nan")), F.concat_ws(",", user, item, F.lit("nan")),
              F.concat(F.lit("u,"), item, F.lit(",3.0")), F.lit("")]
    value = F.lit(None).cast("string")
    for n, line in enumerate(spoilt):
        value = F.when(which == n, line).otherwise(value)
    return _r(spark, d).select("user_id", "item_id", F.coalesce(value, good).alias("value"))


def _rating_lines(spark, d):
    return _spoilt_lines(spark, d).select("value")


def q_parsed_ratings(spark, d):
    return parse_rating_lines(_rating_lines(spark, d))[0].select("user_id", "item_id", "rating")


def q_rejected_ratings(spark, d):
    return parse_rating_lines(_rating_lines(spark, d))[1]


def q_parsed_items(spark, d):
    """The catalogue of parts as CSV lines (quoted titles with a comma, a
    header line for every seventh item), parsed back."""
    items = tpch_items_with_genres(spark, d)
    line = F.concat(F.col("item_id").cast("string"), F.lit(',"'), "title", F.lit(', The",'),
                    F.array_join("genres", "|"))
    lines = items.select(F.when(F.col("item_id") % 7 == 0, F.lit("itemId,title,genres")).otherwise(line).alias("value"))
    return parse_item_lines(lines).select("item_id", "title", F.size("genres").alias("n_genres"))


def _rating_file(spark, d):
    """The rating view as text files sorted by user and item, with a header line;
    five lines in eleven are spoilt."""
    path = scratch_path(spark, "rating_file")
    write_ratings(_spoilt_lines(spark, d), path, "csv", order=["user_id", "item_id"], header=True)
    return path


def q_file_order_facts(spark, d):
    """The order check of a rating file, with the rows per rating as one text."""
    found = file_order(spark, _rating_file(spark, d))
    text = F.format_string("%.1f:%d", "rating", "n")
    values = found["values"].agg(F.array_join(F.array_sort(F.collect_list(text)), ",")).scalar()
    return found["facts"].withColumn("rating_counts", values)


def q_file_order_offenders(spark, d):
    """The offenders of a file that holds the events as rating lines, with a header."""
    path = scratch_path(spark, "event_file")
    rows = event_rows(spark, d).withColumn("value", F.format_string("%d,%d,3.5", "user_id", "item_id"))
    write_ratings(rows, path, "csv", order=["line"], header=True)
    found = file_order(spark, path)
    return (found["user_steps"].select(F.lit("step").alias("kind"), F.col("prev_user_id").alias("before"),
                                       F.col("user_id").alias("own"), "line")
            .unionAll(found["item_order"].select(F.lit("item"), "prev_item_id", "item_id", "line")))


def _import(spark, d):
    """The spoilt lines in one folder per user modulo 4, imported from there."""
    path = scratch_path(spark, "rating_shelves")
    write_shelves(_spoilt_lines(spark, d).withColumn("shelf", F.col("user_id") % 4), path, "shelf")
    return import_ratings(spark, path, scratch_path(spark, "imported"))


def _shelf():
    return F.regexp_extract("file", r"shelf=(\d+)", 1).cast("long").alias("shelf")


def q_imported_ratings(spark, d):
    return _import(spark, d).ratings.select(_shelf(), "user_id", "item_id", "rating")


def q_import_counts(spark, d):
    """Lines, accepted and rejected ones per folder, and the counters observed in the pass."""
    done = _import(spark, d)
    lines = (done.ratings.select(_shelf(), F.lit(True).alias("ok"))
             .unionAll(done.rejects.select(_shelf(), F.lit(False))))
    return lines.groupBy("shelf").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected"),
        *[F.lit(n).cast("long").alias(f"all_{name}") for name, n in sorted(done.counts.items())])


def q_built_once(spark, d):
    """Builds and reuses of one table: equal rows in any order are reused, another
    parameter or input is built anew."""
    root, r = scratch_path(spark, "built"), write_and_read(_r(spark, d), "ratings")
    fewer = r.filter(F.col("user_id") != F.lit(USER))
    calls = [("first", r, SAMPLE_MIN), ("same", r, SAMPLE_MIN), ("reordered", r.orderBy("rating"), SAMPLE_MIN),
             ("parameter", r, SAMPLE_MIN + 1), ("input", fewer, SAMPLE_MIN), ("input again", fewer, SAMPLE_MIN)]
    rows = []
    for step, table, least in calls:
        made = build_once(spark, root, "active", lambda t=table, m=least: sampling.min_activity(t, m),
                          [table], {"min_count": least})
        rows.append(made.table.agg(F.lit(step).alias("step"), F.lit(made.built).alias("built"),
                                   F.count(F.lit(1)).alias("n_rows"), F.sum("rating").alias("total")))
    return reduce(DataFrame.unionAll, rows)


def q_rating_order_check(spark, d):
    """The order check on the ratings sorted by user and item."""
    key = F.shiftleft("user_id", 32) + F.col("item_id")
    rows = number_rows(_r(spark, d).select("user_id", "item_id", key.alias("_key")), "_key", "line")
    return quality.order_check(rows)


def q_item_activity_histogram(spark, d):
    return quality.activity_histogram(_r(spark, d), "item_id", 20)


def q_user_activity_histogram(spark, d):
    return quality.activity_histogram(_r(spark, d), "user_id", 20)


def q_item_rating_distribution(spark, d):
    # The id filter is pushed through the dedupe aggregate into the parquet scan.
    return quality.item_rating_distribution(_r(spark, d), ITEM)


def q_user_rating_distribution(spark, d):
    return quality.user_rating_distribution(_r(spark, d), USER)


def q_user_order_check(spark, d):
    return quality.order_check(event_rows(spark, d))


def q_user_step_violations(spark, d):
    return quality.user_step_violations(event_rows(spark, d))


def q_item_order_violations(spark, d):
    return quality.item_order_violations(event_rows(spark, d))


def q_last_row_facts(spark, d):
    return quality.last_row_facts(event_rows(spark, d))


def q_item_catalog(spark, d):
    return quality.item_catalog(_items(spark, d))


def q_items_with_genres(spark, d):
    return item_genres(tpch_items_with_genres(spark, d))


# -- sampling and splits -----------------------------------------------------

def q_sample_items(spark, d):
    return sampling.sample_ids(_items(spark, d), "item_id", SAMPLE_ITEMS, SAMPLE_SEED)


def q_sample_users(spark, d):
    return sampling.sample_ids(tpch_users(spark, d), "user_id", SAMPLE_USERS, SAMPLE_SEED)


def _restricted(spark, d):
    return sampling.restrict(_r(spark, d), q_sample_users(spark, d), q_sample_items(spark, d))


def q_restrict_ratings(spark, d):
    return _restricted(spark, d)


def q_min_activity(spark, d):
    return sampling.min_activity(_r(spark, d), SAMPLE_MIN)


def q_dense_user_ids(spark, d):
    return sampling.dense_ids(q_min_activity(spark, d), "user_id", "new_id")


def q_kept_users(spark, d):
    return sampling.kept_users(q_min_activity(spark, d))


def q_sampled_ratings(spark, d):
    return sampling.sample_ratings(_r(spark, d), tpch_users(spark, d), _items(spark, d),
                                   SAMPLE_USERS, SAMPLE_ITEMS, SAMPLE_MIN, SAMPLE_SEED)


def q_split_sizes(spark, d):
    return sampling.split_sizes(_split(spark, d, BASELINE_SEEDS))


def q_union_splits(spark, d):
    s = _split(spark, d, SEED)
    return sampling.union_splits(sampling.part(s, "train"), sampling.part(s, "validation")).select(
        "user_id", "item_id", "rating")


def q_prediction_pairs(spark, d):
    return sampling.keys_only(sampling.part(_split(spark, d, SEED), "test"))


# -- aggregates --------------------------------------------------------------

def q_user_means(spark, d):
    return user_means(_r(spark, d))


def q_item_stats(spark, d):
    return item_stats(_r(spark, d))


def q_item_counts(spark, d):
    return item_counts(_r(spark, d))


def q_user_histories(spark, d):
    return user_histories(_r(spark, d))


# -- baseline ----------------------------------------------------------------

def _baseline(spark, d, seeds):
    # Predictions carry the actual rating, so the errors need no second join.
    s = _split(spark, d, seeds)
    train = _part(s, "train", "validation")
    test = _part(s, "test")
    return predict_mean(test, user_means(train, ["seed"]), ["seed"], keep=["rating"])


def q_baseline_predictions(spark, d):
    return _baseline(spark, d, SEED).drop("seed", "rating")


def q_prediction_errors(spark, d):
    # Users' means from the training part, known for some users only: users
    # with too few training ratings get no prediction.
    s = _split(spark, d, SEED)
    train, test = _part(s, "train").drop("seed"), _part(s, "test").drop("seed")
    known = sampling.min_activity(train, PREDICT_MIN)
    pred = predict_mean(test.join(known.select("user_id").distinct(), "user_id", "left_semi"), user_means(known))
    return errors(pred, test, digits=DIGITS)


def q_baseline_errors(spark, d):
    return mean_over_seeds(errors_of(_baseline(spark, d, BASELINE_SEEDS), ["seed"]), (), DIGITS)


# -- user kNN ----------------------------------------------------------------

def q_co_rating_pairs(spark, d):
    return co_ratings(_written(spark, d))


def q_co_ratings_with_duplicates(spark, d):
    return aligned_sums(tpch_rating_lines(spark, d), MIN_COMMON)


def q_user_similarity(spark, d):
    return user_similarity(_r(spark, d))


def q_directed_similarity(spark, d):
    return directed(user_similarity(_r(spark, d)))


def q_top_neighbours(spark, d):
    # The result itself, read once: not stored.
    return top_neighbours(_r(spark, d), K, MIN_COMMON, stored=False)


def _knn_setup(spark, d, seeds):
    s = _split(spark, d, seeds)
    train = _part(s, "train")
    nbrs = top_neighbours(train, K_GRID[-1], MIN_COMMON, by=["seed"])
    return s, train, nbrs, user_means(train, ["seed"])


def q_knn_predictions(spark, d):
    s, train, nbrs, means = _knn_setup(spark, d, SEED)
    pairs = sampling.keys_only(_part(s, "test"), ["seed"])
    return predict_user_knn(pairs, nbrs, train, means, K, ["seed"], DIGITS).drop("seed")


def _knn_errors_by_k(spark, d):
    s, train, nbrs, means = _knn_setup(spark, d, KNN_SEEDS)
    errs = knn_errors_by_k(_part(s, "validation"), nbrs, train, means, K_GRID, ["seed"])
    return mean_over_seeds(errs, ["k"], DIGITS)


def q_knn_errors_by_k(spark, d):
    return _knn_errors_by_k(spark, d)


def q_knn_test_errors(spark, d):
    s, train, nbrs, means = _knn_setup(spark, d, KNN_SEEDS)
    pred = predict_user_knn(_part(s, "test"), nbrs, train, means, K, ["seed"], keep=["rating"])
    return mean_over_seeds(errors_of(pred, ["seed"]), (), DIGITS)


def q_best_k(spark, d):
    return best_setting(_knn_errors_by_k(spark, d), "k")


def q_knn_recommendations(spark, d):
    return recommend_user_knn(top_neighbours(_r(spark, d), K, MIN_COMMON), _r(spark, d), K, REC_N, digits=DIGITS)


def q_knn_recommendations_titled(spark, d):
    return attach_titles(q_knn_recommendations(spark, d), _items(spark, d))


def q_knn_recommendations_for_user(spark, d):
    r = _written(spark, d)
    target = r.filter(F.col("user_id") == F.lit(USER)).select("user_id").distinct()
    nbrs = write_and_read(neighbours_for_users(r, target, K, MIN_COMMON), "neighbours")
    # At most K neighbours: only their ratings are moved.
    rated = r.join(nbrs.select(F.col("nb").alias("user_id")).distinct(), "user_id", "left_semi")
    recs = recommend_user_knn(nbrs, rated, K, REC_N, digits=DIGITS)
    return attach_titles(recs, _items(spark, d))


# -- popularity, catalogue ---------------------------------------------------

def q_popular_items(spark, d):
    return popular_items(_r(spark, d), _items(spark, d), POPULAR_MIN, POPULAR_N)


def q_unrated_items(spark, d):
    return unrated_items(_r(spark, d), _items(spark, d), USER)


# -- ALS ---------------------------------------------------------------------

def q_als_predictions(spark, d):
    s = _split(spark, d, SEED)
    model = als.fit_als(_part(s, "train").drop("seed"), ALS_RANK, ALS_ITER, ALS_REG, SEED)
    return als.predict_als(model, sampling.keys_only(_part(s, "test"))).select(
        "user_id", "item_id", "prediction")


def q_als_scored_pairs(spark, d):
    """The test pairs that get a prediction: user and item occur in training."""
    return q_als_predictions(spark, d).select("user_id", "item_id")


def q_als_candidates(spark, d):
    """What one user can be recommended: unrated, with more than
    ALS_MIN_COUNT ratings, with its name and count."""
    r, items = _r(spark, d), _items(spark, d)
    return als.candidates(unrated_items(r, items, USER), r, items, ALS_MIN_COUNT)


def q_als_errors_by_rank(spark, d):
    errs = als.als_grid_errors(_written(spark, d), [(r, ALS_ITER) for r in ALS_RANKS], ALS_GRID_SEEDS, ALS_REG)
    return mean_over_seeds(errs, ["rank"], DIGITS)


def q_als_errors_by_iterations(spark, d):
    """One fit for all seeds and iterations: errors are read along the way."""
    s = _split(spark, d, ALS_SEEDS)
    fit = factors.fit_path(_part(s, "train"), ALS_RANK, max(ALS_ITERS), ALS_REG, ["seed"], ALS_ITERS, stored=False)
    actual = _part(s, "validation")
    scored = factors.path_predictions(actual, *fit, ["seed"], ["rating"], fit.solvers)
    # Pairs without a prediction count in the coverage of every iteration.
    n_all = actual.groupBy("seed").agg(F.count(F.lit(1)).alias("n_all"))
    errs = (errors_of(scored, ["seed", "iteration"]).join(n_all, "seed")
            .select("seed", F.col("iteration").alias("iterations"), "rmse", "mae", "n", (F.col("n") / F.col("n_all")).alias("coverage")))
    return mean_over_seeds(errs, ["iterations"], DIGITS)


def q_als_factor_errors(spark, d):
    """Test errors after each of a few steps, all seeds in one fit, that SQL can follow."""
    s = _split(spark, d, ALS_SEEDS)
    fit = factors.fit_path(_part(s, "train"), SMALL_RANK, SMALL_ITERS, ALS_REG, ["seed"], stored=False)
    scored = factors.path_predictions(_part(s, "test"), *fit, ["seed"], ["rating"], fit.solvers)
    return mean_over_seeds(errors_of(scored, ["seed", "iteration"]), ["iteration"], DIGITS).drop("coverage")


def _small_factors(r):
    return factors.fit_path(r, SMALL_RANK, SMALL_ITERS, ALS_REG, keep=[SMALL_ITERS])


def q_als_factor_steps(spark, d):
    """User and item factors after a few steps, that SQL can follow."""
    users, items = _small_factors(_r(spark, d))
    parts = [t.select(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id"),
                      *[F.round(F.get("factors", F.lit(k)), DIGITS).alias(f"f{k + 1}") for k in range(SMALL_RANK)])
             for t, kind, c in ((users, "user", "user_id"), (items, "item", "item_id"))]
    return parts[0].unionAll(parts[1])


def q_als_recommendations_all(spark, d):
    """Lists for all users, from those factors."""
    r = _written(spark, d)
    users, items = _small_factors(r)
    return factors.recommend_lists(users, items, r, _items(spark, d), REC_N, ALS_MIN_COUNT, DIGITS)


def q_als_reloaded_predictions(spark, d):
    """Test pairs scored by the fitted model and by its factor tables, saved and
    loaded: whether the two agree."""
    s = _split(spark, d, SEED)
    model = als.fit_als(_part(s, "train").drop("seed"), ALS_RANK, ALS_ITER, ALS_REG, SEED)
    pairs = sampling.keys_only(_part(s, "test"))
    path = scratch_path(spark, "factors")
    factors.save_factors(*factors.model_factors(model), path)
    loaded = factors.predict_factors(pairs, *factors.load_factors(spark, path))
    direct = als.predict_als(model, pairs).select("user_id", "item_id", F.col("prediction").alias("_direct"))
    return loaded.join(direct, ["user_id", "item_id"], "full").select(
        "user_id", "item_id", F.coalesce(F.abs(F.col("prediction") - F.col("_direct")) <= 1e-6 * F.greatest(
            F.lit(1.0), F.abs("_direct")), F.lit(False)).alias("agrees"))


def q_als_test_errors(spark, d):
    errs = als.als_grid_errors(_written(spark, d), [(ALS_RANK, ALS_ITER)], ALS_SEEDS, ALS_REG,
                               evaluate_on="test")
    return mean_over_seeds(errs, (), DIGITS)


def q_als_recommendations(spark, d):
    r = _written(spark, d)
    model = als.fit_als(r, ALS_RANK, ALS_ITER, ALS_REG, ALS_FINAL_SEED)
    return als.recommend_als(model, r, _items(spark, d), USER, REC_N, ALS_MIN_COUNT)


QUERIES: dict[str, Query] = {
    "ratings": q_ratings,
    "row_counts": q_row_counts,
    "preview": q_preview,
    "rating_distribution": q_rating_distribution,
    "overall_mean": q_overall_mean,
    "parsed_ratings": q_parsed_ratings,
    "rejected_ratings": q_rejected_ratings,
    "parsed_items": q_parsed_items,
    "rating_order_check": q_rating_order_check,
    "file_order_facts": q_file_order_facts,
    "file_order_offenders": q_file_order_offenders,
    "imported_ratings": q_imported_ratings,
    "import_counts": q_import_counts,
    "built_once": q_built_once,
    "item_activity_histogram": q_item_activity_histogram,
    "user_activity_histogram": q_user_activity_histogram,
    "item_rating_distribution": q_item_rating_distribution,
    "user_rating_distribution": q_user_rating_distribution,
    "user_order_check": q_user_order_check,
    "user_step_violations": q_user_step_violations,
    "item_order_violations": q_item_order_violations,
    "last_row_facts": q_last_row_facts,
    "item_catalog": q_item_catalog,
    "items_with_genres": q_items_with_genres,
    "sample_items": q_sample_items,
    "sample_users": q_sample_users,
    "restrict_ratings": q_restrict_ratings,
    "min_activity": q_min_activity,
    "dense_user_ids": q_dense_user_ids,
    "kept_users": q_kept_users,
    "sampled_ratings": q_sampled_ratings,
    "split_sizes": q_split_sizes,
    "union_splits": q_union_splits,
    "prediction_pairs": q_prediction_pairs,
    "user_means": q_user_means,
    "item_stats": q_item_stats,
    "item_counts": q_item_counts,
    "user_histories": q_user_histories,
    "baseline_predictions": q_baseline_predictions,
    "prediction_errors": q_prediction_errors,
    "baseline_errors": q_baseline_errors,
    "top_neighbours": q_top_neighbours,
    "knn_predictions": q_knn_predictions,
    "knn_errors_by_k": q_knn_errors_by_k,
    "knn_test_errors": q_knn_test_errors,
    "best_k": q_best_k,
    "knn_recommendations": q_knn_recommendations,
    "knn_recommendations_titled": q_knn_recommendations_titled,
    "knn_recommendations_for_user": q_knn_recommendations_for_user,
    "popular_items": q_popular_items,
    "unrated_items": q_unrated_items,
    "als_predictions": q_als_predictions,
    "als_scored_pairs": q_als_scored_pairs,
    "als_candidates": q_als_candidates,
    "als_errors_by_rank": q_als_errors_by_rank,
    "als_errors_by_iterations": q_als_errors_by_iterations,
    "als_factor_steps": q_als_factor_steps,
    "als_factor_errors": q_als_factor_errors,
    "als_recommendations_all": q_als_recommendations_all,
    "als_reloaded_predictions": q_als_reloaded_predictions,
    "als_test_errors": q_als_test_errors,
    "als_recommendations": q_als_recommendations,
    # Whole pair sets, the largest outputs (about 1.1M, 2.2M and 11.8M rows
    # at sf0.01), last.
    "co_ratings_with_duplicates": q_co_ratings_with_duplicates,
    "user_similarity": q_user_similarity,
    "directed_similarity": q_directed_similarity,
    "co_rating_pairs": q_co_rating_pairs,
}
