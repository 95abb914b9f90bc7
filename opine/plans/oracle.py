"""DuckDB twins of the exact queries, over the same parquet tables.

Each statement is written from the rules of the operator, not from the Spark plan.
"""

from __future__ import annotations

from html.entities import name2codepoint

from opine.functions.stopwords import ENGLISH
from opine.operators.features import NUM_FEATURES

ORACLES: dict[str, str] = {}

STOPWORD_LIST = ", ".join(f"'{w}'" for w in ENGLISH)
ENTITY_MAP = "MAP {" + ", ".join(f"'{n}': chr({c})" for n, c in sorted(name2codepoint.items())) + "}"


def _code_point(number: str) -> str:
    return (
        f"CASE WHEN ({number}) BETWEEN 1 AND 55295 OR ({number}) BETWEEN 57344 AND 1114111 "
        f"THEN chr(({number})::INTEGER) ELSE chr(65533) END"
    )


def html_text(raw: str) -> str:
    """SQL for: drop scripts, styles, comments, tags; decode entities once."""
    stripped = (
        rf"regexp_replace(regexp_replace({raw}, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', "
        r"'', 'g'), '<[A-Za-z/!?][^>]*>', '', 'g')"
    )
    rest = "substr(p, strpos(p, ';') + 1)"
    name = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*);', 1)"
    decimal = "regexp_extract(p, '^#([0-9]{1,7});', 1)::BIGINT"
    hexadecimal = "('0x' || regexp_extract(p, '^#[xX]([0-9a-fA-F]{1,6});', 1))::BIGINT"
    return f"""array_to_string(list_transform(string_split({stripped}, '&'), lambda p, i: CASE
        WHEN i = 1 THEN p
        WHEN regexp_matches(p, '^[A-Za-z][A-Za-z0-9]*;') THEN coalesce({ENTITY_MAP}[{name}] || {rest}, '&' || p)
        WHEN regexp_matches(p, '^#[0-9]{{1,7}};') THEN {_code_point(decimal)} || {rest}
        WHEN regexp_matches(p, '^#[xX][0-9a-fA-F]{{1,6}};') THEN {_code_point(hexadecimal)} || {rest}
        ELSE '&' || p END), '')"""


def words(text: str) -> str:
    letters = f"regexp_replace({text}, '[^a-zA-Z]', ' ', 'g')"
    return f"list_filter(string_split_regex(lower({letters}), ' +'), lambda w: w <> '')"


def no_stopwords(word_list: str) -> str:
    return f"list_filter({word_list}, lambda w: w NOT IN ({STOPWORD_LIST}))"


def joined(word_list: str) -> str:
    return f"array_to_string({word_list}, ' ')"


def review(raw: str) -> str:
    return joined(no_stopwords(words(html_text(raw))))


def md5_bucket(value: str, buckets: int) -> str:
    return f"('0x' || substr(md5({value}), 1, 8))::BIGINT % {buckets}"


def flat(text: str) -> str:
    return rf"regexp_replace({text}, '[\t\r\n]', ' ', 'g')"


LABELLED = "labelled AS (SELECT doc_id, quality::DOUBLE AS label, text FROM documents JOIN labels USING (doc_id))"
UNLABELLED = "unlabelled AS (SELECT doc_id, text FROM documents ANTI JOIN labels USING (doc_id))"

# --- sources -----------------------------------------------------------------------

ORACLES["src_labeled_tsv"] = (
    f"WITH {LABELLED} SELECT doc_id::VARCHAR AS id, label, {flat('text')} AS review FROM labelled"
)
ORACLES["src_unlabeled_tsv"] = f"WITH {UNLABELLED} SELECT doc_id::VARCHAR AS id, {flat('text')} AS review FROM unlabelled"
ORACLES["src_drop_header_by_value"] = (
    f"WITH {LABELLED} SELECT doc_id::VARCHAR AS id, label::VARCHAR AS label, {flat('text')} AS review FROM labelled"
)

# --- text cleaning -----------------------------------------------------------------

ORACLES["clean_html_text"] = f"SELECT page_id, {html_text('html')} AS text FROM pages"
ORACLES["clean_letters_only"] = (
    "SELECT doc_id, regexp_replace(text, '[^a-zA-Z]', ' ', 'g') AS letters FROM documents"
)
ORACLES["clean_wordlist"] = (
    f"WITH w AS (SELECT doc_id, {words('text')} AS words FROM documents) "
    f"SELECT doc_id, len(words)::INTEGER AS n_words, {joined('words')} AS words FROM w"
)
ORACLES["clean_stopwords"] = (
    f"WITH w AS (SELECT doc_id, {no_stopwords(words('text'))} AS words FROM documents) "
    f"SELECT doc_id, len(words)::INTEGER AS n_words, {joined('words')} AS words FROM w"
)
ORACLES["clean_wordlist_keep_stopwords"] = (
    f"WITH w AS (SELECT page_id, {words(html_text('html'))} AS words FROM pages) "
    f"SELECT page_id, len(words)::INTEGER AS n_words, {joined('words')} AS words FROM w"
)
ORACLES["clean_review"] = f"SELECT doc_id, {review('text')} AS review FROM documents"


def sentence_list(text: str) -> str:
    marked = rf"regexp_replace(replace({text}, chr(1), ' '), '([.!?]+)[ \t\r\n]+', '\1' || chr(1), 'g')"
    blanks = "' ' || chr(9) || chr(10) || chr(13)"
    trimmed = f"list_transform(string_split({marked}, chr(1)), lambda s: trim(s, {blanks}))"
    return f"list_filter({trimmed}, lambda s: s <> '')"


def sentence_rows(table: str) -> str:
    return (
        f"lists AS (SELECT doc_id, {sentence_list('text')} AS parts FROM {table}), "
        "rows AS (SELECT doc_id, unnest(range(len(parts))) AS idx, parts FROM lists), "
        "sentences AS (SELECT doc_id, idx::INTEGER AS sent_pos, parts[idx + 1] AS sentence FROM rows)"
    )


ORACLES["sentence_split"] = f"WITH {sentence_rows('documents')} SELECT * FROM sentences"
ORACLES["sentence_corpus"] = (
    f"WITH {UNLABELLED}, {sentence_rows('unlabelled')} "
    f"SELECT doc_id, sent_pos, {joined(words(html_text('sentence')))} AS words FROM sentences"
)
# A word type: letters with periods inside, and marks around it; then whether a period follows.
_TYPE = r"""^["''(\[]*((?:[A-Za-z]+\.)*[A-Za-z]+)(\.?)["'')\],;:!?]*$"""
_LAST = r"""^["''(\[]*((?:[A-Za-z]+\.)*[A-Za-z]+)\.$"""
_BLANKS = r"string_split_regex({}, '[ \t\r\n]+')"
TYPES = f"""
spoken AS (SELECT unnest({_BLANKS.format("text")}) AS token FROM documents),
typed AS (SELECT lower(regexp_extract(token, '{_TYPE}', 1)) AS type, regexp_extract(token, '{_TYPE}', 2) = '.' AS ended
          FROM spoken WHERE regexp_matches(token, '{_TYPE}')),
counts AS (SELECT type, count(*) FILTER (ended) AS n_with, count(*) FILTER (NOT ended) AS n_without FROM typed GROUP BY type),
chance AS (SELECT sum(n_with)::DOUBLE / sum(n_with + n_without)::DOUBLE AS p FROM counts),
sized AS (SELECT *, length(replace(type, '.', ''))::DOUBLE AS letters, length(type) - length(replace(type, '.', '')) + 1 AS periods
          FROM counts, chance WHERE n_with > 0),
learnt AS (SELECT type, n_with, n_without, CASE WHEN p < 1 THEN
    -2 * ((n_with * ln(p) + n_without * ln(1 - p)) - (n_with * ln(0.99::DOUBLE) + n_without * ln(1 - 0.99::DOUBLE)))
    * exp(-letters) * periods * pow(letters, -n_without::DOUBLE) ELSE 0 END + 0 AS score FROM sized)
"""
ORACLES["sentence_abbreviations"] = (
    f"WITH {TYPES} SELECT type, n_with, n_without, round(score, 6) + 0 AS score, score >= 0.3::DOUBLE AS is_abbreviation FROM learnt"
)
_PIECES = (
    r"string_split(regexp_replace(replace(text, chr(1), ' '), '([.!?]+)([ \t\r\n])', '\1' || chr(1) || '\2', 'g'), chr(1))"
)
ORACLES["sentence_split_learnt"] = (
    f"WITH {TYPES}, known AS (SELECT coalesce(list(type), []) AS types FROM learnt WHERE score >= 0.3::DOUBLE), "
    f"closed AS (SELECT doc_id, array_to_string(list_transform({_PIECES}, lambda p: CASE WHEN "
    f"list_contains(types, lower(regexp_extract({_BLANKS.format('p')}[-1], '{_LAST}', 1))) THEN p ELSE p || chr(1) END), '') AS marked "
    "FROM documents, known), "
    "lists AS (SELECT doc_id, list_filter(list_transform(string_split(marked, chr(1)), "
    "lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13))), lambda s: s <> '') AS parts FROM closed), "
    "rows AS (SELECT doc_id, unnest(range(len(parts))) AS idx, parts FROM lists) "
    "SELECT doc_id, idx::INTEGER AS sent_pos, parts[idx + 1] AS sentence FROM rows"
)

ORACLES["ml_tokenizer"] = (
    f"WITH t AS (SELECT doc_id, string_split({review('text')}, ' ') AS words FROM documents) "
    "SELECT doc_id, len(words)::INTEGER AS n_tokens, array_to_string(words, '|') AS tokens FROM t"
)

# --- word ranking ------------------------------------------------------------------

ORACLES["filter_polarity"] = f"WITH {LABELLED} SELECT * FROM labelled WHERE label = 1"


def exploded(table: str, where: str = "true") -> str:
    return (
        f"lists AS (SELECT doc_id, string_split({review('text')}, ' ') AS parts FROM {table} WHERE {where}), "
        "rows AS (SELECT doc_id, unnest(range(len(parts))) AS idx, parts FROM lists), "
        "exploded AS (SELECT doc_id, idx::INTEGER AS pos, parts[idx + 1] AS word FROM rows)"
    )


COUNTS = "SELECT word, count(*) AS n FROM exploded GROUP BY word"
TOP = COUNTS + " ORDER BY n DESC, word LIMIT 100"

ORACLES["explode_words"] = f"WITH {exploded('documents')} SELECT * FROM exploded"
ORACLES["word_count"] = f"WITH {exploded('documents')} {COUNTS}"
ORACLES["top_words_all"] = f"WITH {exploded('documents')} {TOP}"
ORACLES["top_words_positive"] = f"WITH {LABELLED}, {exploded('labelled', 'label = 1')} {TOP}"
ORACLES["top_words_negative"] = f"WITH {LABELLED}, {exploded('labelled', 'label = 0')} {TOP}"

# --- splits ------------------------------------------------------------------------


def part(key: str, percent: int) -> str:
    return f"CASE WHEN {md5_bucket(key + '::VARCHAR', 100)} < {percent} THEN 'train' ELSE 'test' END"


ORACLES["split_hash_60_40"] = f"SELECT doc_id, {part('doc_id', 60)} AS part FROM documents"
ORACLES["split_hash_90_10"] = f"SELECT doc_id, {part('doc_id', 90)} AS part FROM documents"

# --- features ----------------------------------------------------------------------

TERMS = (
    f"{LABELLED}, tokens AS (SELECT doc_id, label, unnest(string_split({review('text')}, ' ')) AS word FROM labelled), "
    f"terms AS (SELECT doc_id, label, ({md5_bucket('word', NUM_FEATURES)})::INTEGER AS bucket, count(*) AS tf "
    "FROM tokens GROUP BY ALL)"
)


def weights(where: str = "true") -> str:
    return (
        f"used AS (SELECT bucket, count(DISTINCT doc_id) AS df FROM terms WHERE {where} GROUP BY bucket), "
        f"buckets AS (SELECT unnest(range({NUM_FEATURES}))::INTEGER AS bucket), "
        "weights AS (SELECT bucket, coalesce(df, 0)::BIGINT AS df, "
        f"ln(((SELECT count(*) FROM labelled WHERE {where}) + 1.0::DOUBLE) / (coalesce(df, 0) + 1.0::DOUBLE)) AS idf "
        "FROM buckets LEFT JOIN used USING (bucket))"
    )


ORACLES["hashing_tf"] = f"WITH {TERMS} SELECT doc_id, bucket, tf FROM terms"
ORACLES["idf_weights"] = f"WITH {TERMS}, {weights()} SELECT bucket, df, round(idf, 6) AS idf FROM weights"
ORACLES["tfidf_features"] = (
    f"WITH {TERMS}, {weights()} SELECT doc_id, bucket, round(tf * idf, 6) AS tfidf FROM terms JOIN weights USING (bucket)"
)


# --- Murmur3 buckets -----------------------------------------------------------------

# Arithmetic of 32 bits without sign, in wider numbers.
_WORD = 4294967296


def _times(a: str, b: int) -> str:
    return f"(({a})::HUGEINT * {b} % {_WORD})::BIGINT"


def _turned(a: str, bits: int) -> str:
    return f"((({a}) << {bits}) % {_WORD} + (({a}) >> {32 - bits}))"


def _stirred(k: str) -> str:
    """Murmur3's treatment of four bytes before they enter the state."""
    return _times(_turned(_times(k, 3432918353), 15), 461845907)


# Words are ASCII here. `blocks` are whole groups of four bytes, `tail` what is left; the seed is 42.
MURMUR = f"""
spelled AS (SELECT word, list_transform(string_split(word, ''), lambda c: ascii(c)::BIGINT) AS b, length(word) AS n
            FROM (SELECT DISTINCT word FROM tokens)),
grouped AS (SELECT word, n,
    list_transform(range(n // 4), lambda i: b[4*i+1] + 256 * b[4*i+2] + 65536 * b[4*i+3] + 16777216 * b[4*i+4]) AS blocks,
    CASE n % 4 WHEN 0 THEN 0 WHEN 1 THEN b[n] WHEN 2 THEN b[n-1] + 256 * b[n]
               ELSE b[n-2] + 256 * b[n-1] + 65536 * b[n] END AS tail FROM spelled),
mixed AS (SELECT word, n, tail, list_reduce(list_prepend(42::BIGINT, blocks),
    lambda h, k: ({_times(_turned("xor(h, " + _stirred("k") + ")", 13), 5)} + 3864292196) % {_WORD}) AS h FROM grouped),
tailed AS (SELECT word, xor(CASE WHEN n % 4 > 0 THEN xor(h, {_stirred("tail")}) ELSE h END, n) AS h FROM mixed),
folded AS (SELECT word, {_times("xor(h, h >> 16)", 2246822507)} AS h FROM tailed),
folded_twice AS (SELECT word, {_times("xor(h, h >> 13)", 3266489909)} AS h FROM folded),
murmur AS (SELECT word, xor(h, h >> 16) - CASE WHEN xor(h, h >> 16) >= 2147483648 THEN {_WORD} ELSE 0 END AS h FROM folded_twice)
"""

ML_TERMS = (
    f"{LABELLED}, reviews AS (SELECT doc_id, label, {review('text')} AS review FROM labelled), "
    "tokens AS (SELECT doc_id, label, unnest(string_split(review, ' ')) AS word FROM reviews), "
    f"{MURMUR}, terms AS (SELECT doc_id, label, ((h % {NUM_FEATURES} + {NUM_FEATURES}) % {NUM_FEATURES})::INTEGER AS bucket, "
    "count(*) AS tf FROM tokens JOIN murmur USING (word) GROUP BY ALL)"
)
ORACLES["hashing_tf_ml"] = f"WITH {ML_TERMS} SELECT doc_id, bucket, tf::DOUBLE AS tf FROM terms"
ORACLES["tfidf_ml"] = (
    f"WITH {ML_TERMS}, {weights()} SELECT doc_id, label, bucket, round(tf * idf, 6) AS tfidf "
    "FROM terms JOIN weights USING (bucket) WHERE tf * idf <> 0"
)

ORACLES["label_index"] = (
    "WITH n AS (SELECT quality, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY quality), "
    "i AS (SELECT quality, row_number() OVER (ORDER BY n DESC, quality) - 1 AS indexed FROM n) "
    "SELECT doc_id, quality::DOUBLE AS label, indexed::DOUBLE AS indexed "
    "FROM labels JOIN documents USING (doc_id) JOIN i USING (quality)"
)

# Fixed word vectors of `doc_vectors_given`: dimension k from the md5 of "word:k", for words of three letters and more.
_DIMENSIONS = ", ".join(
    "floor(coalesce(sum(CASE WHEN length(word) >= 3 THEN "
    f"(({md5_bucket(f"word || ':{k}'", 2001)}) - 1000)::DOUBLE END), 0) / greatest(count(word), 1) * 1e6::DOUBLE + 0.3::DOUBLE)::BIGINT AS d{k}"
    for k in range(4)
)
ORACLES["doc_vectors_given"] = (
    f"WITH lists AS (SELECT doc_id, {words(html_text('text'))} AS parts FROM documents), "
    "rows AS (SELECT doc_id, unnest(CASE WHEN len(parts) = 0 THEN [NULL] ELSE parts END) AS word FROM lists) "
    f"SELECT doc_id, {_DIMENSIONS} FROM rows GROUP BY doc_id"
)

# --- naive Bayes -------------------------------------------------------------------

IN_TRAIN = f"{part('doc_id', 60)} = 'train'"
NB_RULES = (
    f"{weights(IN_TRAIN)}, "
    f"weighted AS (SELECT doc_id, label, {part('doc_id', 60)} AS part, bucket, tf * idf AS w "
    "FROM terms JOIN weights USING (bucket)), "
    f"train AS (SELECT * FROM labelled WHERE {IN_TRAIN}), "
    "classes AS (SELECT label, count(*) AS n_docs FROM train GROUP BY label), "
    "priors AS (SELECT label, ln(n_docs + 1.0::DOUBLE) - ln((SELECT count(*) FROM train) "
    "+ (SELECT count(*) FROM classes)::DOUBLE) AS prior FROM classes), "
    "sums AS (SELECT label, bucket, sum(w) AS w FROM weighted WHERE part = 'train' GROUP BY label, bucket), "
    "totals AS (SELECT label, sum(w) AS total FROM sums GROUP BY label), "
    "model AS (SELECT priors.label, buckets.bucket, "
    f"ln(coalesce(sums.w, 0) + 1.0::DOUBLE) - ln(totals.total + {NUM_FEATURES}::DOUBLE) AS theta, prior "
    "FROM priors CROSS JOIN buckets LEFT JOIN sums ON sums.label = priors.label AND sums.bucket = buckets.bucket "
    "JOIN totals ON totals.label = priors.label), "
    "scores AS (SELECT doc_id, weighted.label AS label, model.label AS class, max(prior) + sum(w * theta) AS score "
    "FROM weighted JOIN model USING (bucket) WHERE part = 'test' GROUP BY ALL), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) AS place FROM scores), "
    "predictions AS (SELECT doc_id, label, class AS prediction FROM ranked WHERE place = 1)"
)

NB = f"{TERMS}, {NB_RULES}"
NB_ML = f"{ML_TERMS}, {NB_RULES}"

ORACLES["nb_ml_predictions"] = (
    f"WITH {NB_ML}, best AS (SELECT doc_id, max(score) AS most, max(score) FILTER (class = 1) AS one FROM scores GROUP BY doc_id), "
    "shares AS (SELECT doc_id, exp(max(one) - max(most)) / sum(exp(score - most)) AS score FROM scores JOIN best USING (doc_id) "
    "GROUP BY doc_id) SELECT doc_id, label, prediction, round(shares.score, 6) AS score FROM predictions JOIN shares USING (doc_id)"
)
ORACLES["pipeline_nb"] = f"WITH {NB_ML} SELECT review, label, prediction FROM predictions JOIN reviews USING (doc_id, label)"
ORACLES["nb_model"] = (
    f"WITH {NB} SELECT label, bucket, round(theta, 6) AS theta, round(prior, 6) AS prior FROM model"
)
ORACLES["nb_predictions"] = f"WITH {NB} SELECT * FROM predictions"

# Tuning: every model is counted from its own training rows; fold -1 stands for none left out.
NB_GRID = f"""
{LABELLED}, parted AS (SELECT doc_id, label, text, {part('doc_id', 60)} AS part, ({md5_bucket("'fold:' || doc_id::VARCHAR", 3)})::INTEGER AS fold FROM labelled),
tokens AS (SELECT doc_id, label, part, fold, unnest(string_split({review('text')}, ' ')) AS word FROM parted),
sizes AS (SELECT unnest([300, 400])::INTEGER AS v),
outs AS (SELECT unnest([-1, 0, 1, 2])::INTEGER AS fold_out),
terms AS (SELECT doc_id, label, part, fold, v, {md5_bucket("word", 1 << 32)} % v AS bucket, count(*) AS tf FROM tokens, sizes GROUP BY ALL),
train_docs AS (SELECT fold_out, doc_id, label FROM parted, outs WHERE part = 'train' AND fold <> fold_out),
n_docs AS (SELECT fold_out, count(*) AS n_all, count(DISTINCT label) AS n_classes FROM train_docs GROUP BY fold_out),
n_class AS (SELECT fold_out, label, count(*) AS n FROM train_docs GROUP BY ALL),
train_terms AS (SELECT fold_out, v, bucket, label, doc_id, tf FROM terms, outs WHERE part = 'train' AND fold <> fold_out),
dfs AS (SELECT fold_out, v, bucket, count(DISTINCT doc_id) AS df FROM train_terms GROUP BY ALL),
grid AS (SELECT fold_out, v, unnest(range(v)) AS bucket FROM outs, sizes),
idfs AS (SELECT fold_out, v, bucket, ln((n_all + 1.0::DOUBLE) / (coalesce(df, 0) + 1.0::DOUBLE)) AS idf
         FROM grid LEFT JOIN dfs USING (fold_out, v, bucket) JOIN n_docs USING (fold_out)),
used AS (SELECT fold_out, v, bucket, label, sum(tf) AS tf FROM train_terms GROUP BY ALL),
ws AS (SELECT idfs.fold_out, idfs.v, idfs.bucket, n_class.label, idf, n, coalesce(tf, 0) * idf AS w
       FROM idfs JOIN n_class ON n_class.fold_out = idfs.fold_out LEFT JOIN used
       ON used.fold_out = idfs.fold_out AND used.v = idfs.v AND used.bucket = idfs.bucket AND used.label = n_class.label),
totals AS (SELECT fold_out, v, label, sum(w) AS total FROM ws GROUP BY ALL),
models AS (SELECT fold_out, v, s, label, bucket, idf * (ln(w + s) - ln(total + s * v)) AS weight, ln(n + s) - ln(n_all + s * n_classes) AS prior
           FROM ws JOIN totals USING (fold_out, v, label) JOIN n_docs USING (fold_out), (SELECT unnest([0.01, 0.1, 1.0]::DOUBLE[]) AS s)),
joint AS (SELECT fold_out, v, s, models.label AS class, doc_id, terms.label AS label, part, max(prior) + sum(tf * weight) AS score
          FROM terms JOIN models USING (v, bucket)
          WHERE (part = 'train' AND fold = fold_out) OR (part = 'test' AND fold_out = -1) GROUP BY ALL),
by_score AS (SELECT fold_out, v, s, round(score, 6) AS score, sum(label) AS pos, sum(1 - label) AS neg
             FROM joint WHERE part = 'train' AND class = 1 GROUP BY fold_out, v, s, round(score, 6)),
running AS (SELECT fold_out, v, s, pos, neg, sum(pos) OVER w - pos AS before FROM by_score
            WINDOW w AS (PARTITION BY fold_out, v, s ORDER BY score DESC)),
areas AS (SELECT fold_out, v, s, sum(neg * (before + pos / 2)) / (sum(pos) * sum(neg)) AS area FROM running GROUP BY fold_out, v, s),
results AS (SELECT v AS num_features, s AS strength, avg(area) AS avg_metric FROM areas GROUP BY v, s),
best AS (SELECT num_features, strength FROM results ORDER BY avg_metric DESC NULLS LAST, num_features, strength LIMIT 1)
"""
ORACLES["cv_nb_relational"] = f"WITH {NB_GRID} SELECT num_features, strength, round(avg_metric, 6) AS avg_metric FROM results"
ORACLES["cv_nb_relational_predictions"] = (
    f"WITH {NB_GRID}, ranked AS (SELECT doc_id, label, class, num_features, strength, "
    "row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) AS place "
    "FROM joint JOIN best ON v = num_features AND s = strength WHERE part = 'test') "
    "SELECT doc_id, label, class AS prediction, num_features, strength FROM ranked WHERE place = 1"
)

# --- clustering --------------------------------------------------------------------

ASSIGNED = """
points AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS idx FROM embeddings),
first_two AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS cluster FROM embeddings ORDER BY vec_id LIMIT 2),
centres AS (SELECT cluster, idx, x FROM points JOIN first_two USING (vec_id)),
distances AS (SELECT points.vec_id, cluster, sum((points.x - centres.x) ** 2) AS dist2
              FROM points JOIN centres USING (idx) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist2, cluster) AS place FROM distances),
assigned AS (SELECT vec_id, cluster::INTEGER AS cluster, dist2 FROM ranked WHERE place = 1)
"""

ORACLES["kmeans_assign"] = f"WITH {ASSIGNED} SELECT vec_id, cluster, round(dist2, 6) AS dist2 FROM assigned"
ORACLES["metric_wssse"] = (
    f"WITH {ASSIGNED} SELECT round(sum(sqrt(dist2)), 6) AS sum_dist, round(sum(dist2), 6) AS wssse FROM assigned"
)

ORACLES["stream_assign_given"] = ORACLES["kmeans_assign"]

# Coefficient i of the given model is ((i * 7) % 11 - 5) / 10, the intercept 0.05.
ORACLES["lr_given_scores"] = (
    "WITH points AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS idx "
    "FROM embeddings), scored AS (SELECT vec_id, 1 / (1 + exp(-(0.05::DOUBLE + "
    "sum(x * (((idx * 7) % 11 - 5) / 10.0::DOUBLE))))) AS score FROM points GROUP BY vec_id) "
    "SELECT vec_id, round(score, 6) AS score, (score >= 0.5::DOUBLE)::INTEGER::DOUBLE AS prediction FROM scored"
)
ORACLES["stream_score_given"] = ORACLES["lr_given_scores"]

# Objective at the given coefficients: mean log loss and 0.1 / 2 times the squared coefficients.
ORACLES["lr_gradient_given"] = (
    "WITH coefficients AS (SELECT unnest(range(64)) AS idx), "
    "weights AS (SELECT idx, ((idx * 7) % 11 - 5) / 10.0::DOUBLE AS w FROM coefficients), "
    "points AS (SELECT vec_id, (label >= 5)::INTEGER AS y, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS idx "
    "FROM embeddings), "
    "scored AS (SELECT vec_id, 1 / (1 + exp(-(0.05::DOUBLE + sum(x * w)))) AS p FROM points JOIN weights USING (idx) GROUP BY vec_id), "
    "gaps AS (SELECT vec_id, idx, x, y, p FROM points JOIN scored USING (vec_id)), "
    "losses AS (SELECT avg(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END) + 0.05::DOUBLE * (SELECT sum(w * w) FROM weights) AS loss "
    "FROM gaps WHERE idx = 0), "
    "slopes AS (SELECT idx::INTEGER AS dim, avg((p - y) * x) + 0.1::DOUBLE * any_value(w) AS gradient "
    "FROM gaps JOIN weights USING (idx) GROUP BY idx "
    "UNION ALL SELECT -1, avg(p - y) FROM gaps WHERE idx = 0) "
    "SELECT dim, round(gradient, 6) AS gradient, round(loss, 6) AS loss FROM slopes, losses"
)


def _given_tree(t: int) -> str:
    """Tree t as its rule says: which leaf, then class 1's twelfths there."""
    x = [f"embedding[{(11 * t + k) % 64 + 1}]::DOUBLE" for k in range(3)]
    leaf = [f"{(5 * node + 7 * t) % 13} / 12.0::DOUBLE" for node in range(3, 7)]
    return (
        f"CASE WHEN {x[0]} <= 0 THEN CASE WHEN {x[1]} <= -0.05::DOUBLE THEN {leaf[0]} ELSE {leaf[1]} END "
        f"ELSE CASE WHEN {x[2]} <= 0.05::DOUBLE THEN {leaf[2]} ELSE {leaf[3]} END END"
    )


ORACLES["rf_given_scores"] = (
    f"WITH scored AS (SELECT vec_id, round(({' + '.join(_given_tree(t) for t in range(5))}) / 5, 6) AS score FROM embeddings) "
    "SELECT vec_id, score, (score > 0.5::DOUBLE)::INTEGER::DOUBLE AS prediction FROM scored"
)
ORACLES["kmeans_best_given"] = """
WITH points AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS idx FROM embeddings),
given AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings ORDER BY vec_id LIMIT 20),
centres AS (SELECT place // 2 AS start, place, idx, x FROM points JOIN given USING (vec_id)),
distances AS (SELECT start, place, points.vec_id, sum((points.x - centres.x) ** 2) AS dist2
              FROM points JOIN centres USING (idx) GROUP BY ALL),
nearest AS (SELECT start, vec_id, min(dist2) AS dist2 FROM distances GROUP BY ALL),
costs AS (SELECT start::INTEGER AS start, round(sum(dist2), 6) AS cost FROM nearest GROUP BY start)
SELECT start, cost, row_number() OVER (ORDER BY cost, start) = 1 AS best FROM costs
"""

# --- evaluation --------------------------------------------------------------------

SCORED = (
    "raw AS (SELECT doc_id, quality::DOUBLE AS label, "
    f"(n_chars % 40 + {md5_bucket('doc_id::VARCHAR', 60)}) / 100.0::DOUBLE AS score "
    "FROM documents JOIN labels USING (doc_id)), "
    "scored AS (SELECT *, (score >= 0.5::DOUBLE)::INTEGER::DOUBLE AS prediction FROM raw)"
)
TP = "count(*) FILTER (prediction = 1 AND label = 1)"
FP = "count(*) FILTER (prediction = 1 AND label = 0)"
P = "count(*) FILTER (label = 1)"
ACCURACY = "round(count(*) FILTER (prediction = label)::DOUBLE / count(*), 6) AS accuracy"
ERROR = "round(1 - count(*) FILTER (prediction = label)::DOUBLE / count(*), 6) AS test_error"
RECALL = f"round({TP}::DOUBLE / nullif({P}, 0), 6) AS recall"
PRECISION = f"round({TP}::DOUBLE / nullif({TP} + {FP}, 0), 6) AS precision"

ORACLES["metric_accuracy"] = f"WITH {SCORED} SELECT count(*) AS n, {ACCURACY} FROM scored"
ORACLES["metric_error_rate"] = f"WITH {SCORED} SELECT {ERROR} FROM scored"
ORACLES["metric_confusion"] = f"WITH {SCORED} SELECT {TP} AS tp, {FP} AS fp, {P} AS positives FROM scored"
ORACLES["metric_precision_recall"] = f"WITH {SCORED} SELECT {PRECISION}, {RECALL} FROM scored"
ORACLES["nb_metrics"] = (
    f"WITH {NB} SELECT count(*) AS n, {ACCURACY}, {ERROR}, {TP} AS tp, {FP} AS fp, {P} AS positives, "
    f"{RECALL}, {PRECISION} FROM predictions"
)

CURVE = (
    f"{SCORED}, by_score AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score), "
    "running AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM by_score "
    "WINDOW w AS (ORDER BY score DESC)), "
    "points AS (SELECT tp, fp, tp / (tp + fp) AS prec, lag(tp, 1, 0) OVER w AS tp0, lag(fp, 1, 0) OVER w AS fp0, "
    "lag(tp / (tp + fp)) OVER w AS prec0 FROM running WINDOW w AS (ORDER BY score DESC))"
)
ORACLES["metric_auc_roc"] = (
    f"WITH {CURVE} SELECT round(sum((fp - fp0) * (tp + tp0) / 2) / (max(tp) * max(fp)), 6) AS auc_roc FROM points"
)
ORACLES["metric_auc_pr"] = (
    f"WITH {CURVE} SELECT round(sum((tp - tp0) * (prec + coalesce(prec0, prec)) / 2) / max(tp), 6) AS auc_pr FROM points"
)

# --- streaming ---------------------------------------------------------------------

# A turn is written with a line end after it; every kind of line end starts a new line.
LINES = (
    "texts AS (SELECT string_split(regexp_replace(text || chr(10), '\\r\\n|\\r', chr(10), 'g'), chr(10)) AS parts "
    "FROM conversations), lines AS (SELECT unnest(parts[:-2]) AS line FROM texts)"
)

ORACLES["stream_source_lines"] = f"WITH {LINES} SELECT line FROM lines"
ORACLES["stream_word_count"] = (
    f"WITH {LINES}, words AS (SELECT unnest(string_split(line, ' ')) AS word FROM lines) "
    "SELECT word, count(*) AS n FROM words GROUP BY word"
)
ORACLES["stream_running_count"] = ORACLES["stream_word_count"]
ORACLES["stream_word_count_per_batch"] = (
    f"WITH {LINES.replace('AS parts', 'AS parts, conv_id // 100 AS piece').replace('AS line FROM', 'AS line, piece FROM')}, "
    "words AS (SELECT piece, unnest(string_split(line, ' ')) AS word FROM lines) "
    "SELECT piece, word, count(*) AS n FROM words GROUP BY piece, word"
)

# Lines by the average of their words' fixed vectors; words without one count in the divisor.
_AVERAGES = ", ".join(
    "coalesce(sum(CASE WHEN length(word) >= 3 THEN "
    f"(({md5_bucket(f"word || ':{k}'", 2001)}) - 1000)::DOUBLE END), 0) / greatest(count(word), 1) AS d{k}"
    for k in range(4)
)
LINE_VECTORS = (
    f"{LINES}, numbered AS (SELECT row_number() OVER () AS nth, line FROM lines), "
    f"lists AS (SELECT nth, line, {words(html_text('line'))} AS parts FROM numbered), "
    "spread AS (SELECT nth, line, unnest(CASE WHEN len(parts) = 0 THEN [NULL] ELSE parts END) AS word FROM lists), "
    f"averages AS (SELECT nth, line, {_AVERAGES} FROM spread GROUP BY nth, line)"
)
_TEXT_SCORED = (
    f"{LINE_VECTORS}, scored AS (SELECT line AS text, round(1 / (1 + exp(-(0.05::DOUBLE + 0.002::DOUBLE * d0 - 0.001::DOUBLE * d1 "
    "+ 0.0015::DOUBLE * d2 - 0.0025::DOUBLE * d3))), 6) AS score FROM averages)"
)
ORACLES["stream_score_text_given"] = (
    f"WITH {_TEXT_SCORED} SELECT text, score, (score >= 0.5::DOUBLE)::INTEGER::DOUBLE AS prediction FROM scored"
)
ORACLES["stream_score_sink"] = (
    f"WITH {_TEXT_SCORED} SELECT text, (score >= 0.5::DOUBLE)::INTEGER::DOUBLE AS prediction FROM scored"
)
ORACLES["stream_assign_text_given"] = (
    f"WITH {LINE_VECTORS}, far AS (SELECT line, (d0 - 100) ** 2 + d1 ** 2 + (d2 + 50) ** 2 + (d3 - 25) ** 2 AS a, "
    "(d0 + 100) ** 2 + (d1 - 50) ** 2 + d2 ** 2 + (d3 + 25) ** 2 AS b FROM averages) "
    "SELECT line AS text, (a > b)::INTEGER AS cluster, floor(least(a, b) * 1000 + 0.314159::DOUBLE)::BIGINT AS dist2_thousandths FROM far"
)
ORACLES["stream_clean"] = f"WITH {LINES} SELECT line, {joined(words(html_text('line')))} AS words FROM lines"
