"""The registered queries: name -> function of (spark, folder) that gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opine.functions import text as tx
from opine.functions.hashing import md5_bucket
from opine.operators import abbreviations, bayes, bayes_tuning, clusters, embeddings, explore, features, forests, metrics, models, splits, tuning
from opine.plans import derived, recipes
from opine.session import new_folder, path_bytes, spread, stage
from opine.sources import tables, tsv
from opine.streaming import jobs, lines

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

TRAIN_PERCENT = 60
SPLIT_SEED = 42
DIGITS = 6


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _rounded(value: str | Column) -> Column:
    return F.round(value, DIGITS)


def _joined(words: str | Column) -> Column:
    return F.array_join(words, " ")


# --- sources -----------------------------------------------------------------------


def _with_one_header(spark: SparkSession, reviews: DataFrame, purpose: str) -> str:
    """Write reviews as a data set of several files: an empty first one, one that holds the header line only, and
    many without one."""
    path = new_folder(spark, purpose)
    reviews.limit(0).select(F.lit("").alias("value")).write.text(f"{path}/part=0")
    tsv.write_tsv(reviews.limit(0), f"{path}/part=1")
    tsv.write_tsv(reviews, f"{path}/part=2", header=False)
    return f"{path}/part=*"


@query
def src_labeled_tsv(spark: SparkSession, folder: str) -> DataFrame:
    reviews = tables.labelled_reviews(spark, folder)
    reviews = reviews.select(F.col("doc_id").alias("id"), F.col("label"), F.col("text").alias("review"))
    return tsv.read_labelled(spark, _with_one_header(spark, reviews, "labelled-tsv"))


@query
def src_unlabeled_tsv(spark: SparkSession, folder: str) -> DataFrame:
    reviews = tables.unlabelled_reviews(spark, folder)
    reviews = reviews.select(F.col("doc_id").alias("id"), F.col("text").alias("review"))
    return tsv.read_unlabelled(spark, _with_one_header(spark, reviews, "unlabelled-tsv"))


@query
def src_drop_header_by_value(spark: SparkSession, folder: str) -> DataFrame:
    reviews = tables.labelled_reviews(spark, folder)
    reviews = reviews.select(F.col("doc_id").alias("id"), F.col("label"), F.col("text").alias("review"))
    return tsv.read_dropping_header_value(spark, _with_one_header(spark, reviews, "headed-tsv"))


# --- text cleaning -----------------------------------------------------------------


@query
def clean_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return tables.html_pages(spark, folder).select("page_id", tx.html_to_text(F.col("html")).alias("text"))


@query
def clean_letters_only(spark: SparkSession, folder: str) -> DataFrame:
    return tables.all_reviews(spark, folder).select("doc_id", tx.letters_only(F.col("text")).alias("letters"))


@query
def clean_wordlist(spark: SparkSession, folder: str) -> DataFrame:
    words = tables.all_reviews(spark, folder).select("doc_id", tx.word_list(F.col("text")).alias("words"))
    return words.select("doc_id", F.size("words").alias("n_words"), _joined("words").alias("words"))


@query
def clean_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    kept = tx.without_stopwords(tx.word_list(F.col("text")))
    words = tables.all_reviews(spark, folder).select("doc_id", kept.alias("words"))
    return words.select("doc_id", F.size("words").alias("n_words"), _joined("words").alias("words"))


@query
def clean_wordlist_keep_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    words = tables.html_pages(spark, folder).select("page_id", tx.review_words(F.col("html")).alias("words"))
    return words.select("page_id", F.size("words").alias("n_words"), _joined("words").alias("words"))


@query
def clean_review(spark: SparkSession, folder: str) -> DataFrame:
    return features.cleaned(tables.all_reviews(spark, folder))


@query
def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.sentence_rows(tables.all_reviews(spark, folder))


@query
def sentence_corpus(spark: SparkSession, folder: str) -> DataFrame:
    corpus = embeddings.sentence_corpus(tables.unlabelled_reviews(spark, folder))
    return corpus.select("doc_id", "sent_pos", _joined("words").alias("words"))


def _learnt_abbreviations(spark: SparkSession, folder: str) -> DataFrame:
    return abbreviations.learnt(tables.all_reviews(spark, folder))


@query
def sentence_abbreviations(spark: SparkSession, folder: str) -> DataFrame:
    return _learnt_abbreviations(spark, folder).withColumn("score", _rounded("score"))


@query
def sentence_split_learnt(spark: SparkSession, folder: str) -> DataFrame:
    return abbreviations.sentence_rows(tables.all_reviews(spark, folder), _learnt_abbreviations(spark, folder))


@query
def ml_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    tokens = features.tokenizer().transform(features.cleaned(tables.all_reviews(spark, folder)))
    return tokens.select("doc_id", F.size("words").alias("n_tokens"), F.array_join("words", "|").alias("tokens"))


# --- word ranking ------------------------------------------------------------------


@query
def filter_polarity(spark: SparkSession, folder: str) -> DataFrame:
    return explore.with_polarity(tables.labelled_reviews(spark, folder), 1)


@query
def explode_words(spark: SparkSession, folder: str) -> DataFrame:
    return explore.explode_words(tables.all_reviews(spark, folder))


@query
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return explore.word_count(explore.explode_words(tables.all_reviews(spark, folder)))


@query
def top_words_all(spark: SparkSession, folder: str) -> DataFrame:
    return explore.top_words(tables.all_reviews(spark, folder))


@query
def top_words_positive(spark: SparkSession, folder: str) -> DataFrame:
    return explore.top_words(explore.with_polarity(tables.labelled_reviews(spark, folder), 1))


@query
def top_words_negative(spark: SparkSession, folder: str) -> DataFrame:
    return explore.top_words(explore.with_polarity(tables.labelled_reviews(spark, folder), 0))


# --- splits ------------------------------------------------------------------------


def _document_keys(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_table(spark, folder, "documents").select("doc_id")


@query
def split_hash_60_40(spark: SparkSession, folder: str) -> DataFrame:
    return _document_keys(spark, folder).withColumn("part", splits.hash_part(F.col("doc_id"), 60))


@query
def split_hash_90_10(spark: SparkSession, folder: str) -> DataFrame:
    return _document_keys(spark, folder).withColumn("part", splits.hash_part(F.col("doc_id"), 90))


@query
def split_random(spark: SparkSession, folder: str) -> DataFrame:
    train, test = splits.random_split(_document_keys(spark, folder), [0.6, 0.4], SPLIT_SEED)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# --- features ----------------------------------------------------------------------


@query
def hashing_tf(spark: SparkSession, folder: str) -> DataFrame:
    reviews = features.cleaned(tables.labelled_reviews(spark, folder)).drop("label")
    return features.term_rows(features.with_bucket_counts(reviews))


def _whole_corpus_weights(spark: SparkSession, folder: str) -> DataFrame:
    return features.idf_weights(derived.review_terms(spark, folder), derived.cleaned_reviews(spark, folder))


@query
def idf_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _whole_corpus_weights(spark, folder).select("bucket", "df", _rounded("idf").alias("idf"))


@query
def tfidf_features(spark: SparkSession, folder: str) -> DataFrame:
    weighted = features.tfidf(derived.review_terms(spark, folder), _whole_corpus_weights(spark, folder))
    return weighted.select("doc_id", "bucket", _rounded("tfidf").alias("tfidf"))


@query
def label_index(spark: SparkSession, folder: str) -> DataFrame:
    reviews = tables.labelled_reviews(spark, folder).select("doc_id", "label")
    return features.label_indexer().fit(reviews).transform(reviews)


def _ml_features(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-corpus TF and TF-IDF by Spark ML."""
    stages = [features.tokenizer(), features.hashing_tf(), features.idf()]
    reviews = derived.cleaned_reviews(spark, folder)
    return Pipeline(stages=stages).fit(reviews).transform(reviews)


@query
def hashing_tf_ml(spark: SparkSession, folder: str) -> DataFrame:
    words = features.tokenizer().transform(derived.cleaned_reviews(spark, folder))
    counted = features.hashing_tf().transform(words)
    return features.vector_rows(counted.select("doc_id", "rawFeatures"), "rawFeatures", "tf")


@query
def tfidf_ml(spark: SparkSession, folder: str) -> DataFrame:
    weighted = _ml_features(spark, folder).select("doc_id", "label", "features")
    return features.vector_rows(weighted, "features", "tfidf").withColumn("tfidf", _rounded("tfidf"))


@query
def word2vec_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return derived.word_vectors(spark, folder)


@query
def doc_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = derived.document_vectors(spark, folder)
    return vectors.select("doc_id", "label", vector_to_array("features").alias("features"))


def word_vector(word: Column, size: int) -> Column:
    """Fixed vectors by a rule: dimension k of a word from the md5 of "word:k". Whole numbers, so sums are exact."""
    numbers = [md5_bucket(F.concat(word, F.lit(f":{k}")), 2001) for k in range(size)]
    return F.array(*[(n - 1000).cast("double") for n in numbers])


GIVEN_VECTOR_SIZE = 4


def given_vectors(documents: DataFrame) -> DataFrame:
    """word, vector: fixed vectors of the words of `documents` that have three letters and more."""
    known = documents.select(F.explode("words").alias("word")).where(F.length("word") >= 3).distinct()
    return known.select("word", word_vector(F.col("word"), GIVEN_VECTOR_SIZE).alias("vector"))


@query
def doc_vectors_given(spark: SparkSession, folder: str) -> DataFrame:
    """Averages of given word vectors, in millionths: words of three letters and more have one."""
    documents = stage(embeddings.word_lists(tables.all_reviews(spark, folder)), "word-lists")
    vectors = stage(given_vectors(documents), "given-vectors")
    averaged = embeddings.average_vectors(documents, vectors, size=GIVEN_VECTOR_SIZE)
    # No average of fewer than ten million words has a seventh digit that lies on this cut.
    millionths = [F.floor(F.get("features", F.lit(k)) * 1e6 + 0.3).cast("bigint") for k in range(GIVEN_VECTOR_SIZE)]
    columns = [d.alias(f"d{k}") for k, d in enumerate(millionths)]
    return averaged.select("doc_id", *columns)


# --- models ------------------------------------------------------------------------


def _split_reviews(spark: SparkSession, folder: str, percent: int) -> tuple[DataFrame, DataFrame]:
    return splits.hash_split(derived.cleaned_reviews(spark, folder), "doc_id", percent)


def _split_vectors(spark: SparkSession, folder: str, percent: int) -> tuple[DataFrame, DataFrame]:
    return splits.hash_split(derived.document_vectors(spark, folder), "doc_id", percent)


@query
def lr_tfidf_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, test = _split_reviews(spark, folder, TRAIN_PERCENT)
    return models.score(_text_pipeline(spark, folder, "lr"), test)


@query
def lr_w2v_predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split_vectors(spark, folder, 60)
    return models.score(models.logistic_regression().fit(train), test)


@query
def lr_lbfgs_tfidf_predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split_reviews(spark, folder, 90)
    return models.score(tuning.fit_pipeline(train, models.lbfgs_logistic_regression()), test)


@query
def lr_lbfgs_w2v_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, test = _split_vectors(spark, folder, 90)
    classifier = derived.lr_on_vectors(spark, folder).stages[-1]
    return models.score(classifier, test)


def _text_pipeline(spark: SparkSession, folder: str, kind: str) -> PipelineModel:
    """The text pipeline with logistic regression ("lr") or naive Bayes ("nb"), fitted once on the training rows."""

    def make() -> PipelineModel:
        train, _ = _split_reviews(spark, folder, TRAIN_PERCENT)
        return tuning.fit_pipeline(train, models.logistic_regression() if kind == "lr" else models.naive_bayes())

    return derived.once(spark, folder, f"text_pipeline_{kind}", make)


@query
def nb_ml_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, test = _split_reviews(spark, folder, TRAIN_PERCENT)
    scored = models.score(_text_pipeline(spark, folder, "nb"), test)
    return scored.withColumn("score", _rounded("score"))


def _nb_training(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The training rows' IDF weights and the naive Bayes model of the training rows."""
    terms = derived.review_terms(spark, folder)
    train, _ = _split_reviews(spark, folder, TRAIN_PERCENT)
    weights = features.idf_weights(terms.where(F.col("part") == "train"), train)
    weighted = features.tfidf(terms.where(F.col("part") == "train"), weights)
    return weights, bayes.fit(weighted, train)


@query
def nb_model(spark: SparkSession, folder: str) -> DataFrame:
    _, model = _nb_training(spark, folder)
    return model.select("label", "bucket", _rounded("theta").alias("theta"), _rounded("prior").alias("prior"))


@query
def nb_predictions(spark: SparkSession, folder: str) -> DataFrame:
    weights, model = _nb_training(spark, folder)
    test = derived.review_vectors(spark, folder).where(F.col("part") == "test").drop("part")
    return bayes.predict_rows(test, model, weights)


GIVEN_SIZE = 64


def given_coefficients() -> list[float]:
    """Fixed values by a rule: one coefficient for each of the 64 dimensions."""
    return [((i * 7) % 11 - 5) / 10 for i in range(GIVEN_SIZE)]


def _given_score(point: Column) -> Column:
    return models.logistic_score(point, given_coefficients(), 0.05)


@query
def lr_given_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic scoring by given coefficients."""
    points = tables.read_table(spark, folder, "embeddings")
    scored = points.select("vec_id", _given_score(F.col("embedding")).alias("score"))
    return scored.select("vec_id", _rounded("score").alias("score"), (F.col("score") >= 0.5).cast("double").alias("prediction"))


@query
def lr_gradient_given(spark: SparkSession, folder: str) -> DataFrame:
    """The objective and its gradient at the given coefficients; labels of five and more are 1."""
    points = tables.read_table(spark, folder, "embeddings")
    labelled = points.select((F.col("label") >= 5).cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("point"))
    found = models.logistic_gradient(labelled, given_coefficients(), 0.05, 0.1)
    return found.select("dim", _rounded("gradient").alias("gradient"), _rounded("loss").alias("loss"))


GIVEN_TREES = 5


def given_trees() -> list[tuple]:
    """Fixed trees by a rule: two levels of splits on features 11t, 11t + 1 and 11t + 2, class 1 in twelfths."""
    rows = []
    for t in range(GIVEN_TREES):
        for node, threshold in enumerate((0.0, -0.05, 0.05)):
            rows.append((t, node, (11 * t + node) % GIVEN_SIZE, threshold, 2 * node + 1, 2 * node + 2, [0.5, 0.5]))
        for node in range(3, 7):
            one = ((5 * node + 7 * t) % 13) / 12
            rows.append((t, node, -1, None, -1, -1, [1 - one, one]))
    return rows


@query
def rf_given_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring by given trees, which come as a table of nodes."""
    nodes = spark.createDataFrame(given_trees(), forests.NODES)
    points = tables.read_table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("point"))
    scored = forests.score(points, nodes, depth=2).select("vec_id", F.get("shares", F.lit(1)).alias("score"))
    return scored.select("vec_id", _rounded("score").alias("score"), (_rounded("score") > 0.5).cast("double").alias("prediction"))


@query
def rf_w2v_predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split_vectors(spark, folder, 60)
    return models.score_forest(models.fit_random_forest(train), test)


@query
def rf_tfidf_predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split_reviews(spark, folder, 60)
    stages = [features.tokenizer(), features.hashing_tf(), features.idf()]
    to_features: PipelineModel = Pipeline(stages=stages).fit(train)
    forest = models.fit_random_forest(to_features.transform(train).select("label", "features"))
    return models.score_forest(forest, to_features.transform(test))


@query
def kmeans_best_of_10(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _split_vectors(spark, folder, TRAIN_PERCENT)
    assigned = clusters.assign_by_model(train, derived.kmeans_on_vectors(spark, folder))
    return assigned.select("doc_id", "cluster", F.sqrt("dist2").alias("dist"))


def _points(spark: SparkSession, folder: str) -> DataFrame:
    table = tables.read_table(spark, folder, "embeddings")
    return table.select("vec_id", F.col("embedding").cast("array<double>").alias("point"))


def _given_centres(spark: SparkSession, folder: str) -> list[list[float]]:
    """The vectors with the two lowest ids."""
    return [row.point for row in _points(spark, folder).orderBy("vec_id").limit(2).collect()]


def _assigned_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings assigned to the two given centres."""
    size = path_bytes(spark, tables.table_path(folder, "embeddings"))
    return clusters.assign(spread(_points(spark, folder), size), _given_centres(spark, folder))


@query
def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    return _assigned_embeddings(spark, folder).select("vec_id", "cluster", _rounded("dist2").alias("dist2"))


STARTS = 10


@query
def kmeans_best_given(spark: SparkSession, folder: str) -> DataFrame:
    """The cost of ten given starts, each a pair of the vectors with the lowest ids, and which is the lowest."""
    given = [row.point for row in _points(spark, folder).orderBy("vec_id").limit(2 * STARTS).collect()]
    costs = clusters.costs_of_starts(_points(spark, folder), [given[2 * n : 2 * n + 2] for n in range(STARTS)])
    costs = costs.withColumn("cost", _rounded("cost"))
    best = F.row_number().over(Window.orderBy("cost", "start")) == 1  # ten rows
    return costs.withColumn("best", best)


# --- evaluation --------------------------------------------------------------------


def scored_labels(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed scored table: quality as label, a score made of n_chars and the hashed id."""
    labels = tables.read_table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    documents = tables.read_table(spark, folder, "documents").select("doc_id", "n_chars")
    score = (F.pmod("n_chars", F.lit(40)) + md5_bucket(F.col("doc_id"), 60)) / F.lit(100.0)
    scored = documents.join(labels, "doc_id").select("doc_id", "label", score.cast("double").alias("score"))
    return scored.withColumn("prediction", (F.col("score") >= 0.5).cast("double"))


@query
def metric_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return scored_labels(spark, folder).agg(
        F.count(F.lit(1)).alias("n"), _rounded(metrics.accuracy()).alias("accuracy")
    )


@query
def metric_error_rate(spark: SparkSession, folder: str) -> DataFrame:
    return scored_labels(spark, folder).agg(_rounded(metrics.error_rate()).alias("test_error"))


@query
def metric_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return scored_labels(spark, folder).agg(
        metrics.true_positives().alias("tp"),
        metrics.false_positives().alias("fp"),
        metrics.positives().alias("positives"),
    )


@query
def metric_precision_recall(spark: SparkSession, folder: str) -> DataFrame:
    return scored_labels(spark, folder).agg(
        _rounded(metrics.precision()).alias("precision"), _rounded(metrics.recall()).alias("recall")
    )


@query
def metric_auc_roc(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.auc_roc(scored_labels(spark, folder)).select(_rounded("auc_roc").alias("auc_roc"))


@query
def metric_auc_pr(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.auc_pr(scored_labels(spark, folder)).select(_rounded("auc_pr").alias("auc_pr"))


@query
def metric_wssse(spark: SparkSession, folder: str) -> DataFrame:
    sums = clusters.distance_sums(_assigned_embeddings(spark, folder))
    return sums.select(_rounded("sum_dist").alias("sum_dist"), _rounded("wssse").alias("wssse"))


@query
def nb_metrics(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.classification_report(nb_predictions(spark, folder))
    ratios = ("accuracy", "test_error", "recall", "precision")
    return report.withColumns({name: _rounded(name) for name in ratios})


# --- pipelines and tuning ----------------------------------------------------------


@query
def pipeline_lr(spark: SparkSession, folder: str) -> DataFrame:
    _, test = _split_reviews(spark, folder, TRAIN_PERCENT)
    return _text_pipeline(spark, folder, "lr").transform(test).select("review", "label", "prediction")


@query
def pipeline_nb(spark: SparkSession, folder: str) -> DataFrame:
    _, test = _split_reviews(spark, folder, TRAIN_PERCENT)
    return _text_pipeline(spark, folder, "nb").transform(test).select("review", "label", "prediction")


def _cross_validated(spark: SparkSession, folder: str, kind: str) -> tuning.Tuned:
    def make() -> tuning.Tuned:
        train, _ = _split_reviews(spark, folder, 60)
        classifier = models.logistic_regression() if kind == "lr" else models.naive_bayes()
        return tuning.fit_cross_validated(train, classifier)

    return derived.once(spark, folder, f"cross_validated_{kind}", make)


@query
def cv_lr_results(spark: SparkSession, folder: str) -> DataFrame:
    return tuning.grid_results_frame(spark, _cross_validated(spark, folder, "lr"))


@query
def cv_nb_results(spark: SparkSession, folder: str) -> DataFrame:
    return tuning.grid_results_frame(spark, _cross_validated(spark, folder, "nb"))


@query
def cv_best_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, test = _split_reviews(spark, folder, 60)
    return _cross_validated(spark, folder, "lr").transform(test).select("doc_id", "review", "prediction", "label")


def _tuned_bayes(spark: SparkSession, folder: str) -> bayes_tuning.Tuned:
    return derived.once(spark, folder, "tuned_bayes", lambda: bayes_tuning.tune(_split_reviews(spark, folder, TRAIN_PERCENT)[0]))


@query
def cv_nb_relational(spark: SparkSession, folder: str) -> DataFrame:
    return _tuned_bayes(spark, folder).results.withColumn("avg_metric", _rounded("avg_metric"))


@query
def cv_nb_relational_predictions(spark: SparkSession, folder: str) -> DataFrame:
    tuned = _tuned_bayes(spark, folder)
    _, test = _split_reviews(spark, folder, TRAIN_PERCENT)
    setting = {"num_features": F.lit(tuned.num_features), "strength": F.lit(tuned.strength)}
    return tuned.predict(test.select("doc_id", "label", "review")).withColumns(setting)


# --- the fitted models, evaluated on their test rows ---------------------------------

RATIOS = ("accuracy", "test_error", "recall", "precision")


def _evaluated(scored: DataFrame) -> DataFrame:
    """The report and both areas: one row."""
    report = recipes.report(scored)
    return report.withColumns({name: _rounded(name) for name in (*RATIOS, "auc_roc", "auc_pr")})


@query
def lr_lbfgs_tfidf_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _evaluated(lr_lbfgs_tfidf_predictions(spark, folder))


@query
def lr_lbfgs_w2v_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _evaluated(lr_lbfgs_w2v_predictions(spark, folder))


@query
def lr_w2v_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _evaluated(lr_w2v_predictions(spark, folder))


@query
def rf_w2v_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _evaluated(rf_w2v_predictions(spark, folder))


@query
def cv_best_metrics(spark: SparkSession, folder: str) -> DataFrame:
    _, test = _split_reviews(spark, folder, 60)
    return _evaluated(models.score(_cross_validated(spark, folder, "lr").bestModel, test))


@query
def kmeans_distance_sums(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _split_vectors(spark, folder, TRAIN_PERCENT)
    return clusters.distance_sums(clusters.assign_by_model(train, derived.kmeans_on_vectors(spark, folder)))


# --- streaming ---------------------------------------------------------------------

def line_folder(spark: SparkSession, folder: str) -> str:
    """Conversation turns as a folder of text files, a new one for each query."""
    path = new_folder(spark, "stream-lines")
    lines.write_lines(tables.conversation_lines(spark, folder), path)
    return path


def _line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The lines as a stream, paced by the fixed batch size."""
    return lines.read_lines(spark, line_folder(spark, folder))


def _appended(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all that is there, into files, and read the files back."""
    spark = stream.sparkSession
    out = new_folder(spark, name)
    jobs.finish(jobs.start_append(stream, out, new_folder(spark, name + "-checkpoint"), interval=None))
    return spark.read.schema(stream.schema).parquet(out)


def _batched_word_counts(stream: DataFrame, schema: StructType | str = jobs.WORD_COUNTS) -> DataFrame:
    spark = stream.sparkSession
    out = new_folder(spark, "stream-word-count")
    jobs.finish(jobs.start_word_count(stream, out, new_folder(spark, "stream-word-count-checkpoint"), interval=None))
    return jobs.read_batches(spark, out, StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def _scored_lines(spark: SparkSession, folder: str, model: PipelineModel, prediction: str = "prediction") -> DataFrame:
    """Save the model, load it as a separate streaming program would, and score every line."""
    saved = new_folder(spark, "model")
    model.save(saved)
    scored = jobs.score_lines(_line_stream(spark, folder), PipelineModel.load(saved), prediction)
    out = new_folder(spark, "stream-scores")
    jobs.finish(jobs.start_batches(scored, out, new_folder(spark, "stream-scores-checkpoint"), interval=None))
    return jobs.read_batches(spark, out, jobs.SCORES)


@query
def stream_source_lines(spark: SparkSession, folder: str) -> DataFrame:
    stream = lines.read_lines(spark, line_folder(spark, folder)).withColumnRenamed("value", "line")
    return _appended(stream, "stream-source")


@query
def stream_word_count(spark: SparkSession, folder: str) -> DataFrame:
    counts = _batched_word_counts(lines.read_lines(spark, line_folder(spark, folder)))
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


CONVERSATIONS_A_FILE = 100


@query
def stream_word_count_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    """What arrives together is one file, and each file is counted by itself; counts are named by the file, whatever the
    order in which files are taken. A trigger takes files up to a fixed number of bytes, so triggers grow with bytes, not
    with files."""
    path = new_folder(spark, "stream-pieces")
    turns = tables.read_table(spark, folder, "conversations")
    pieces = turns.select("text", F.floor(F.col("conv_id") / CONVERSATIONS_A_FILE).alias("piece"))
    lines.write_lines(pieces, path, by="piece")
    counts = _batched_word_counts(lines.read_lines(spark, path, named=True), "source string, word string, n bigint")
    piece = F.regexp_extract("source", r"piece=(-?[0-9]+)", 1).cast("bigint")
    return counts.select(piece.alias("piece"), "word", "n")


@query
def stream_running_count(spark: SparkSession, folder: str) -> DataFrame:
    """Totals since the start, after a stop and a restart: half of the lines arrive before, half after."""
    path, out = new_folder(spark, "stream-halves"), new_folder(spark, "stream-running")
    checkpoint = new_folder(spark, "stream-running-checkpoint")
    turns = tables.read_table(spark, folder, "conversations")
    for half in (0, 1):
        lines.write_lines(turns.where(F.pmod("conv_id", F.lit(2)) == half).select("text"), path, mode="append")
        jobs.finish(jobs.start_running_counts(lines.read_lines(spark, path), out, checkpoint, interval=None))
    return jobs.running_totals(spark, out)


@query
def stream_clean(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = jobs.clean_lines(lines.read_lines(spark, line_folder(spark, folder)))
    return _appended(cleaned.select(F.col("value").alias("line"), _joined("words").alias("words")), "stream-clean")


def _embedding_stream(spark: SparkSession, folder: str) -> DataFrame:
    return lines.read_table_stream(spark, f"{folder}/embeddings*.parquet", "vec_id bigint, embedding array<float>")


@query
def stream_score_given(spark: SparkSession, folder: str) -> DataFrame:
    """`lr_given_scores` on a stream."""
    scored = _embedding_stream(spark, folder).select("vec_id", _given_score(F.col("embedding")).alias("score"))
    prediction = (F.col("score") >= 0.5).cast("double").alias("prediction")
    return _appended(scored.select("vec_id", _rounded("score").alias("score"), prediction), "stream-given")


@query
def stream_assign_given(spark: SparkSession, folder: str) -> DataFrame:
    """`kmeans_assign` on a stream."""
    points = _embedding_stream(spark, folder).select("vec_id", F.col("embedding").cast("array<double>").alias("point"))
    assigned = clusters.assign(points, _given_centres(spark, folder))
    return _appended(assigned.select("vec_id", "cluster", _rounded("dist2").alias("dist2")), "stream-assign")


@query
def stream_score_lr(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, streamed as a table so that ids stay."""
    pattern = f"{folder}/documents*.parquet"
    rows = lines.read_table_stream(spark, pattern, "doc_id bigint, text string")
    stream = derived.dealt_out(spread(rows, path_bytes(spark, tables.table_path(folder, "documents"))), folder)
    scored = derived.lr_on_vectors(spark, folder).transform(embeddings.word_lists(stream))
    return _appended(scored.select("doc_id", "prediction"), "stream-lr")


@query
def stream_score_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    model = PipelineModel([derived.word2vec(spark, folder), derived.kmeans_on_vectors(spark, folder)])
    return _scored_lines(spark, folder, model).select("batch_id", "text", "prediction")


# Coefficients and centres for the averages of given word vectors.
TEXT_COEFFICIENTS, TEXT_INTERCEPT = (0.002, -0.001, 0.0015, -0.0025), 0.05
TEXT_CENTRES = ((100.0, 0.0, -50.0, 25.0), (-100.0, 50.0, 0.0, -25.0))


def _text_scored(spark: SparkSession, folder: str, score: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """Raw lines as a stream, scored by a table of given word vectors; what was committed is read back."""
    path = line_folder(spark, folder)
    words = jobs.clean_lines(spark.read.text(path))
    vectors = stage(given_vectors(words), "given-vectors")
    out = new_folder(spark, "stream-text")
    stream = lines.read_lines(spark, path)
    jobs.finish(jobs.start_text_scoring(stream, vectors, score, out, new_folder(spark, "stream-text-checkpoint"), interval=None))
    return jobs.read_committed(spark, out, StructType.fromDDL(schema)).drop("batch_id")


def _text_logistic(averaged: DataFrame) -> DataFrame:
    scored = averaged.select(
        F.col("value").alias("text"), models.logistic_score(F.col("features"), TEXT_COEFFICIENTS, TEXT_INTERCEPT).alias("score")
    )
    return scored.select("text", _rounded("score").alias("score"), (_rounded("score") >= 0.5).cast("double").alias("prediction"))


@query
def stream_score_text_given(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic scores of raw lines by given word vectors and coefficients."""
    return _text_scored(spark, folder, _text_logistic, "text string, score double, prediction double")


@query
def stream_assign_text_given(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of raw lines by given word vectors and centres."""

    def assigned(averaged: DataFrame) -> DataFrame:
        found = clusters.assign(averaged, TEXT_CENTRES, "features")
        # Thousandths, cut where no fraction of a line's words can lie.
        thousandths = F.floor(F.col("dist2") * 1000 + 0.314159).cast("bigint").alias("dist2_thousandths")
        return found.select(F.col("value").alias("text"), "cluster", thousandths)

    return _text_scored(spark, folder, assigned, "text string, cluster int, dist2_thousandths bigint")


@query
def stream_score_sink(spark: SparkSession, folder: str) -> DataFrame:
    """text, prediction of every line from the sink with commits, by given word vectors and coefficients."""
    return _text_scored(spark, folder, lambda rows: _text_logistic(rows).drop("score"), "text string, prediction double")
