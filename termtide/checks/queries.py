"""The registered queries: each takes a session and a folder of tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import values as v
from ..functions.accounts import created_on, language_name
from ..operators import cascades, leaders, lookup, merge, signed, sketches, terms, usage
from ..operators import phrases as worth
from ..operators.bursts import burst_states
from ..operators.versions import as_of
from ..plans import build, serve
from ..plans.incremental import Totals, follow
from ..plans.typeahead import TermIndex
from ..schemas import MESSAGE_FIELDS, POST_TYPES, RAW_POST_COLUMNS, RAW_POST_SCHEMA
from ..session import join_hint, new_folder, parts_for
from ..sources import messages as msg
from ..sources.posts import scan_posts_csv
from ..sources.tables import ViewStore, drop_table, keyed_by_month, save_table, write_table
from ..sources.users import scan_users_csv, user_rejects, users_dimension
from ..streaming import windows
from ..streaming.counters import CounterLog, start_counting
from ..streaming.messages import parse_messages
from ..streaming.once import read_late, start_counting_once
from . import adapters

Query = Callable[[SparkSession, str], DataFrame]
SIZE_NAMES = {2: "bigrams", 3: "trigrams", 4: "fourgrams", 5: "fivegrams"}
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rows_of(spark, sf_dir, term, sizes=tx.SIZES):
    posts = adapters.posts(spark, sf_dir)
    return terms.ngram_rows(posts, sizes=sizes, dealt=True) if term == "ngram" else terms.hashtag_rows(posts)


# Sources and sinks.


def _csv_copy(rows: DataFrame, spark: SparkSession) -> str:
    """The rows as CSV files with a header, quotes doubled."""
    path = new_folder(spark, "csv")
    rows.write.csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


@query
def posts_csv_scan(spark, sf_dir):
    raw = adapters.raw_posts(spark, sf_dir).select(*RAW_POST_COLUMNS)
    return scan_posts_csv(spark, _csv_copy(raw, spark))


@query
def users_csv_scan(spark, sf_dir):
    return scan_users_csv(spark, _csv_copy(adapters.raw_users(spark, sf_dir), spark))


@query
def posts_normalized(spark, sf_dir):
    posts = write_table(adapters.clean_posts(spark, sf_dir), new_folder(spark, "posts"), fmt="orc")
    return posts.select(
        *[
            F.array_join(c, "|").alias(c) if t == "array<string>"
            else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t == "timestamp" else c
            for c, t in POST_TYPES.items()
        ]
    )


@query
def users_dim(spark, sf_dir):
    return write_table(users_dimension(adapters.raw_users(spark, sf_dir)), new_folder(spark, "users"))


@query
def users_rejects(spark, sf_dir):
    return user_rejects(users_dimension(adapters.raw_users(spark, sf_dir)))


@query
def sink_roundtrip_append(spark, sf_dir):
    """One append per n-gram size to the same table."""
    name, path = "termtide_appended", new_folder(spark, "appended")
    drop_table(spark, name)
    posts = terms.posts_in_language(adapters.posts(spark, sf_dir)).drop("hashtags")
    words = write_table(terms.with_words(posts), new_folder(spark, "words"))
    for n in tx.SIZES:
        view = usage.usage_by_month(terms.explode_ngrams(words, [n]), "ngram")
        save_table(view, name, "append", path)
    return spark.read.parquet(path)


@query
def sink_roundtrip_overwrite(spark, sf_dir):
    """The second write replaces the first."""
    name, path = "termtide_overwritten", new_folder(spark, "overwritten")
    drop_table(spark, name)
    view = usage.usage_by_month(rows_of(spark, sf_dir, "hashtag"), "hashtag")
    save_table(view, name, "overwrite", path)
    save_table(view, name, "overwrite", path)
    return spark.read.parquet(path)


def _raw_messages(spark, sf_dir):
    return msg.to_messages(adapters.raw_posts(spark, sf_dir))


@query
def csv_to_json_messages(spark, sf_dir):
    """Messages written to files and read back field by field."""
    path = new_folder(spark, "messages")
    msg.write_message_files(_raw_messages(spark, sf_dir), path)
    body = F.from_json("value", RAW_POST_SCHEMA)
    return spark.read.text(path).select(body.alias("body")).select("body.*")


@query
def parse_json_messages(spark, sf_dir):
    value = _raw_messages(spark, sf_dir)
    parsed = parse_messages(value).where(F.col("reason").isNull())
    return parsed.select(F.get_json_object("value", "$.tweetid").alias("tweetid"), *MESSAGE_FIELDS)


# Clean-up of fields.


@query
def posts_english(spark, sf_dir):
    kept = terms.posts_in_language(adapters.posts(spark, sf_dir))
    return kept.withColumn("hashtags", F.array_join("hashtags", "|"))


@query
def normalize_blank_to_null(spark, sf_dir):
    posts = adapters.clean_posts(spark, sf_dir)
    return posts.select(*[c for c, t in POST_TYPES.items() if t == "string"])


@query
def normalize_lists(spark, sf_dir):
    posts = adapters.clean_posts(spark, sf_dir)
    shown = []
    for c in ("hashtags", "urls", "user_mentions", "poll_choices"):
        size = F.when(F.col(c).isNotNull(), F.size(c).cast("bigint"))
        shown += [F.col(c).isNull().alias(f"{c}_null"), size.alias(f"{c}_size")]
    return posts.select("tweetid", *shown)


@query
def normalize_casts(spark, sf_dir):
    posts = adapters.clean_posts(spark, sf_dir)
    cast = [c for c, t in POST_TYPES.items() if t in ("int", "double", "boolean")]
    time = F.date_format("tweet_time", "yyyy-MM-dd HH:mm:ss").alias("tweet_time")
    return posts.select("tweetid", *cast, time)


@query
def parse_list_column(spark, sf_dir):
    raw = adapters.raw_posts(spark, sf_dir)
    return raw.select("tweetid", F.explode(v.parse_list(F.col("hashtags"))).alias("item"))


@query
def explode_hashtags(spark, sf_dir):
    return adapters.posts(spark, sf_dir).select("tweetid", F.explode("hashtags").alias("hashtag"))


@query
def hashtags_nonblank(spark, sf_dir):
    posts = adapters.clean_posts(spark, sf_dir).select("hashtags")
    return terms.explode_hashtags(posts).groupBy("hashtag").agg(F.count("*").alias("uses"))


@query
def month_bucket(spark, sf_dir):
    month = v.month_bucket(F.col("tweet_time")).alias("tweet_month")
    return adapters.posts(spark, sf_dir).select("tweetid", month)


@query
def month_bucket_weekyear(spark, sf_dir):
    month = v.month_bucket(F.col("tweet_time"), week_year=True).alias("tweet_month")
    return adapters.posts(spark, sf_dir).select("tweetid", month)


# Text.


def _register_text() -> None:
    shown = {
        "clean_text": ("text", tx.clean_text),
        "clean_text_url": ("text", lambda t: tx.clean_text(t, tx.URL)),
        "clean_text_retweet": ("text", lambda t: tx.clean_text(t, tx.RETWEET)),
        "clean_text_handle": ("text", lambda t: tx.clean_text(t, tx.HANDLE)),
        "clean_text_hashtag": ("text", lambda t: tx.clean_text(t, tx.HASHTAG)),
        "tokenize": ("tokens", lambda t: F.array_join(tx.tokenize(tx.clean_text(t)), " ")),
    }

    def of(name, column):
        return lambda spark, sf_dir: adapters.posts(spark, sf_dir).select(
            "tweetid", column(F.col("tweet_text")).alias(name)
        )

    for key, (name, column) in shown.items():
        QUERIES[key] = of(name, column)


_register_text()


def _register_sizes() -> None:
    def per_post(n):
        def run(spark, sf_dir):
            worded = terms.with_words(adapters.posts(spark, sf_dir).select("tweetid", "tweet_text"))
            return terms.explode_ngrams(worded, [n])

        return run

    def per_month(n):
        return lambda spark, sf_dir: usage.usage_by_month(
            rows_of(spark, sf_dir, "ngram", [n]), "ngram"
        ).drop(terms.LEAD)

    for n, name in SIZE_NAMES.items():
        QUERIES[name] = per_post(n)
        QUERIES[f"{name}_by_month"] = per_month(n)


_register_sizes()


@query
def remove_stopwords(spark, sf_dir):
    worded = terms.with_words(adapters.posts(spark, sf_dir).select("tweetid", "tweet_text"))
    return worded.select("tweetid", F.array_join("words", " ").alias("tokens"))


# Views, for both kinds of term.


def _register_views(term: str) -> None:
    def by_month(spark, sf_dir):
        return usage.usage_by_month(rows_of(spark, sf_dir, term), term)

    def by_user(spark, sf_dir):
        return usage.usage_by_user(rows_of(spark, sf_dir, term), term)

    def top(spark, sf_dir):
        return leaders.top_users(by_user(spark, sf_dir), term)

    def profiles(spark, sf_dir):
        posts = terms.posts_in_language(adapters.posts(spark, sf_dir))
        return leaders.profiles_of(adapters.users(spark, sf_dir), posts)

    def info(spark, sf_dir):
        return leaders.with_profiles(top(spark, sf_dir), profiles(spark, sf_dir), term)

    def packed(spark, sf_dir):
        return leaders.pack(leaders.collect_leaders(info(spark, sf_dir), term), term)

    def shown(of):
        return lambda spark, sf_dir: of(spark, sf_dir).drop(terms.LEAD)

    def published_months(spark, sf_dir):
        store = ViewStore(new_folder(spark, "views"))
        build.publish_month_view(store, rows_of(spark, sf_dir, term), term)
        return build.read_month_view(spark, store, term)

    def published_leaders(spark, sf_dir):
        store = ViewStore(new_folder(spark, "views"))
        build.publish_top_users(store, rows_of(spark, sf_dir, term), profiles(spark, sf_dir), term)
        return build.read_top_users(spark, store, term)

    QUERIES.update({
        f"{term}s_by_month": shown(by_month),
        f"{term}s_by_user": shown(by_user),
        f"top_users_by_{term}": shown(top),
        f"{term}_top_users_info": shown(info),
        f"{term}_top_users_packed": shown(packed),
        f"publish_{term}s_by_month": published_months,
        f"publish_{term}s_top_users": published_leaders,
    })


_register_views("ngram")
_register_views("hashtag")


@query
def engagement_null_semantics(spark, sf_dir):
    return adapters.posts(spark, sf_dir).groupBy("userid").agg(
        usage.engagement().alias("total_engagement_count"),
        usage.engagement(null_as_zero=True).alias("with_missing_as_zero"),
    )


@query
def unpack_top_users(spark, sf_dir):
    return leaders.unpack(QUERIES["hashtag_top_users_packed"](spark, sf_dir), "hashtag")


# Accounts.


@query
def user_created_parts(spark, sf_dir):
    created = created_on(F.col("account_creation_date"))
    return adapters.raw_users(spark, sf_dir).select(
        "userid",
        F.date_format(created, "yyyy-MM-dd").alias("created"),
        F.year(created).cast("short").alias("account_creation_year"),
        F.month(created).cast("byte").alias("account_creation_month"),
        F.day(created).cast("byte").alias("account_creation_day"),
    )


@query
def user_language_name(spark, sf_dir):
    code = F.col("account_language")
    return adapters.raw_users(spark, sf_dir).select(
        "userid", code.alias("code"), language_name(code).alias("name")
    )


@query
def redact_hashed_users(spark, sf_dir):
    name, handle = F.col("user_display_name"), F.col("user_screen_name")
    hashed = v.is_hashed(name, handle)
    return adapters.hashed_users(spark, sf_dir).select(
        "user_id",
        v.redact(name, hashed).alias("display_name"),
        v.redact(handle, hashed).alias("handle"),
    )


# Changes.


@query
def top_users_after_delta(spark, sf_dir):
    """Totals of some feeds, then the posts of the others: ranks of touched terms only are made again."""
    posts, totals = adapters.posts(spark, sf_dir), Totals(new_folder(spark, "totals"))
    late = F.col("tweet_client_name") >= "src5"
    totals.build(posts.where(~late))
    totals.apply(signed.added(posts.where(late)))
    profiles = leaders.profiles_of(adapters.users(spark, sf_dir))
    return leaders.with_profiles(totals.leaders(spark, "ngram"), profiles, "ngram")


def _followed(spark, sf_dir) -> Totals:
    """Totals of a snapshot that lacks some posts, brought to a later one."""
    posts, totals = adapters.posts(spark, sf_dir), Totals(new_folder(spark, "totals"))
    early = posts.where(F.col("tweetid").cast("bigint") % 6 != 0)
    totals.build(early)
    follow(totals, early, adapters.edited_posts(spark, sf_dir))
    return totals


@query
def views_after_retraction(spark, sf_dir):
    return _followed(spark, sf_dir).months(spark, "ngram")


@query
def accounts_after_retraction(spark, sf_dir):
    return _followed(spark, sf_dir).accounts(spark, "ngram")


@query
def leaders_after_retraction(spark, sf_dir):
    return _followed(spark, sf_dir).leaders(spark, "hashtag")


# Account versions, phrases and completions.


@query
def profiles_as_of(spark, sf_dir):
    """Posts with the profile that was valid at their time."""
    posts = adapters.posts(spark, sf_dir).select("tweetid", "userid", "tweet_time", "tweet_client_name")
    found = as_of(
        posts, adapters.account_versions(spark, sf_dir), ["user_display_name", "user_profile_description"]
    )
    return found.withColumn("tweet_time", F.date_format("tweet_time", "yyyy-MM-dd HH:mm:ss"))


@query
def maximal_phrases(spark, sf_dir):
    counts = write_table(worth.use_counts(rows_of(spark, sf_dir, "ngram")), new_folder(spark, "uses"))
    return worth.maximal(counts)


@query
def collocations(spark, sf_dir):
    found = worth.collocations(rows_of(spark, sf_dir, "ngram", [2]))
    return found.withColumn("log_likelihood", F.round("log_likelihood", 4))


@query
def type_ahead(spark, sf_dir):
    """The five most used phrases that begin with the first letters of each benchmark word."""
    index = TermIndex(new_folder(spark, "index"), blocks=16)
    index.write(worth.use_counts(rows_of(spark, sf_dir, "ngram")), "ngram")
    items = terms.with_words(spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"), text="text")
    prefixes = items.select(F.explode("words").alias("word")).select(F.left("word", F.lit(3)).alias("prefix"))
    return index.complete_many(prefixes, 5)


@query
def accounts_estimated(spark, sf_dir):
    """Distinct accounts of each hashtag from sketches by month, of batch and stream; is the estimate close?"""
    rows = rows_of(spark, sf_dir, "hashtag")
    even = F.pmod(F.xxhash64("userid", "tweet_month"), F.lit(2)) == 0
    both = [sketches.accounts_by_month(rows.where(c), "hashtag") for c in (even, ~even)]
    found = sketches.estimated(sketches.merged(*both, keys=["hashtag"]))
    exact = rows.groupBy("hashtag").agg(F.count_distinct("userid").alias("exact"))
    close = F.abs(F.col("accounts") - F.col("exact")) <= sketches.BOUND * F.col("exact")
    return exact.join(found, "hashtag").select("hashtag", F.col("exact").alias("accounts"), close.alias("close"))


@query
def hashtag_bursts(spark, sf_dir):
    view = usage.usage_by_month(rows_of(spark, sf_dir, "hashtag"), "hashtag")
    return burst_states(view, "hashtag").withColumn("cost", F.round("cost", 4))


@query
def cascade_roots(spark, sf_dir):
    posts = adapters.clean_posts(spark, sf_dir)
    return cascades.roots(posts)


@query
def cascade_sums(spark, sf_dir):
    posts = adapters.clean_posts(spark, sf_dir)
    return cascades.cascade_totals(posts, cascades.roots(posts))


# Lookups.


def phrases(spark, sf_dir):
    """Every two-word phrase of the benchmark items and the hashtag of every source."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    worded = terms.with_words(items.select("text"), text="text")
    two = terms.explode_ngrams(worded, [2]).select(F.col("ngram").alias("phrase"))
    sources = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat(F.lit("#"), F.upper("source")).alias("phrase")
    )
    return two.unionByName(sources).distinct()


@query
def split_serving_key(spark, sf_dir):
    keyed = keyed_by_month(QUERIES["ngrams_by_month"](spark, sf_dir), "ngram").select("key")
    return keyed.select(
        "key", v.key_term(F.col("key")).alias("term"), v.key_month(F.col("key")).alias("month")
    )


@query
def format_counts(spark, sf_dir):
    shown = [v.with_commas(F.col(c)).alias(c) for c in leaders.NUMBERS]
    return QUERIES["hashtags_by_user"](spark, sf_dir).select("hashtag", "userid", *shown)


@query
def lookup_routed(spark, sf_dir):
    return lookup.route(phrases(spark, sf_dir))


def _built_store(spark, sf_dir, users=None) -> ViewStore:
    store = ViewStore(new_folder(spark, "views"))
    build.build_views(spark, adapters.posts(spark, sf_dir), users, store)
    return store


@query
def lookup_by_month(spark, sf_dir):
    store = _built_store(spark, sf_dir)
    return serve.lookup_series(spark, store, lookup.one_term(spark, "#src1"))


@query
def lookup_top_users(spark, sf_dir):
    store = _built_store(spark, sf_dir, adapters.users(spark, sf_dir))
    return serve.lookup(spark, store, "#src1")[1]


@query
def lookup_many(spark, sf_dir):
    return serve.lookup_series(spark, _built_store(spark, sf_dir), phrases(spark, sf_dir))


@query
def lookup_many_users(spark, sf_dir):
    store = _built_store(spark, sf_dir, adapters.users(spark, sf_dir))
    return serve.lookup_users(spark, store, phrases(spark, sf_dir))


@query
def lookup_series_ordered(spark, sf_dir):
    asked = lookup.route(phrases(spark, sf_dir))
    asked = asked.hint(join_hint(asked))
    found = [
        QUERIES[f"{kind}s_by_month"](spark, sf_dir).withColumnRenamed(kind, "term")
        .join(asked.where(F.col("kind") == kind), "term")
        for kind in ("ngram", "hashtag")
    ]
    series = lookup.month_series(found[0].unionByName(found[1]))
    newest = Window.partitionBy("phrase").orderBy(F.desc(v.month_start(F.col("month"))))
    return lookup.newest_first(
        series.select("phrase", "month", F.row_number().over(newest).alias("position"), "count")
    )


def _batch_and_counters(spark, sf_dir, term):
    """Posts of some feeds by way of the batch view, those of the others by the counters."""
    posts = adapters.posts(spark, sf_dir)
    streamed = F.col("tweet_client_name") >= "src5"
    batch = posts.where(~streamed)
    rows = terms.ngram_rows(batch, dealt=True) if term == "ngram" else terms.hashtag_rows(batch)
    log = CounterLog(new_folder(spark, "counters"))
    log.add(posts.where(streamed), 0)
    return usage.usage_by_month(rows, term), log.read(spark, term, parts=parts_for(batch) if term == "ngram" else None)


@query
def lookup_merged(spark, sf_dir):
    return merge.merge_views(*_batch_and_counters(spark, sf_dir, "hashtag"), "hashtag", "left")


@query
def merge_views_full(spark, sf_dir):
    return merge.merge_views(*_batch_and_counters(spark, sf_dir, "ngram"), "ngram", "full").drop(terms.LEAD)


@query
def counters_after_compaction(spark, sf_dir):
    """Batches after a mark, folded, with everything else cleared away."""
    posts, log = adapters.posts(spark, sf_dir), CounterLog(new_folder(spark, "counters"))
    streamed, even = F.col("tweet_client_name") >= "src5", F.col("tweetid").cast("bigint") % 2 == 0
    for n, part in enumerate([~streamed, streamed & even, streamed & ~even]):
        log.add(posts.where(part), n)
    log.compact(spark, after=0, clear=True)
    return log.read(spark, "hashtag", after=0)


@query
def lookup_after_rebuild(spark, sf_dir):
    """The views hold all posts; the log still holds those that were counted before."""
    store, log = ViewStore(new_folder(spark, "views")), CounterLog(new_folder(spark, "counters"))
    posts = adapters.posts(spark, sf_dir)
    log.add(posts.where(F.col("tweet_client_name") >= "src5"), 0)
    build.build_views(spark, posts, None, store, counted=0)
    return serve.lookup_series(spark, store, lookup.one_term(spark, "#src7"), log, "full")


@query
def lookup_levelled_counters(spark, sf_dir):
    """Five batches folded two by two; a table of terms, of which only their buckets are read."""
    posts, log = adapters.posts(spark, sf_dir), CounterLog(new_folder(spark, "counters"))
    for n in range(5):
        log.add(posts.where(F.col("tweetid").cast("bigint") % 5 == n), n)
        log.fold(spark, fanout=2)
    wanted = lookup.route(phrases(spark, sf_dir)).where("kind = 'ngram'")
    return log.read(spark, "ngram", wanted)


# Stream.


def _text_posts(spark, sf_dir):
    """Posts with every field as the text a raw file holds."""
    posts = adapters.listed_posts(spark, sf_dir)
    return posts.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in posts.columns]
    )


def _stream(spark, messages) -> CounterLog:
    """Run messages through the stream in about four micro-batches."""
    path = new_folder(spark, "messages")
    files = 4 * spark.sparkContext.defaultParallelism
    msg.write_message_files(messages.repartition(files), path)
    files = len(spark.read.text(path).inputFiles())
    log = CounterLog(new_folder(spark, "counters"))
    source = msg.file_messages(spark, path, -(-files // 4))
    start_counting(source, log, {"availableNow": True}).awaitTermination()
    return log


@query
def stream_posts_count(spark, sf_dir):
    """A streaming scan and parse of the messages, appended to a table by a plain sink."""
    path, table = new_folder(spark, "messages"), new_folder(spark, "posts")
    msg.write_message_files(msg.to_messages(_text_posts(spark, sf_dir)), path)
    parsed = parse_messages(msg.file_messages(spark, path)).select("reason", *MESSAGE_FIELDS)
    (
        parsed.where(F.col("reason").isNull()).writeStream.format("parquet")
        .option("checkpointLocation", new_folder(spark, "checkpoint"))
        .trigger(availableNow=True).start(table).awaitTermination()
    )
    return spark.read.parquet(table).groupBy("tweet_language").agg(F.count("*").alias("posts"))


@query
def stream_ngram_counters(spark, sf_dir):
    log = _stream(spark, msg.to_messages(_text_posts(spark, sf_dir)))
    return log.read(spark, "ngram")


@query
def stream_hashtag_counters(spark, sf_dir):
    log = _stream(spark, msg.to_messages(_text_posts(spark, sf_dir)))
    log.compact(spark)
    return log.read(spark, "hashtag")


@query
def stream_dead_letter(spark, sf_dir):
    """Some messages are cut short, some lack a field, some have a time that is none."""
    posts = _text_posts(spark, sf_dir)
    number = F.col("tweetid").cast("bigint")
    whole = F.to_json(F.struct(*posts.columns))
    late = F.to_json(F.struct(
        *[F.lit("not a time").alias(c) if c == "tweet_time" else F.col(c) for c in posts.columns]
    ))
    value = (
        F.when(number % 13 == 0, F.expr("left(value, length(value) - 2)"))
        .when(number % 17 == 0, F.to_json(F.struct(*[c for c in posts.columns if c != "tweet_time"])))
        .when(number % 19 == 0, late)
        .otherwise(F.col("value"))
    )
    messages = posts.withColumn("value", whole).select(value.alias("value"))
    letters = _stream(spark, messages).read_dead_letters(spark)
    return letters.groupBy("reason").agg(F.count("*").alias("messages"))


def _in_parts(spark, messages, parts, run) -> None:
    """Append the messages of one part after the other, and restart the stream after each."""
    path = new_folder(spark, "messages")
    for part in parts:
        msg.write_message_files(messages.where(part), path)
        run(msg.file_messages(spark, path)).awaitTermination()


def _counted_once(spark, sf_dir) -> CounterLog:
    """Some posts first; then, after a restart, all posts, so that those come a second time."""
    posts = _text_posts(spark, sf_dir)
    messages = posts.select(F.to_json(F.struct(*posts.columns)).alias("value"), F.col("tweetid").cast("bigint").alias("n"))
    log = CounterLog(new_folder(spark, "counters"))
    _in_parts(
        spark, messages, [F.col("n") % 3 == 0, F.lit(True)],
        lambda source: start_counting_once(source, log, "1000 days", trigger={"availableNow": True}),
    )
    return log


@query
def stream_counted_once(spark, sf_dir):
    return _counted_once(spark, sf_dir).read(spark, "ngram")


@query
def stream_late_messages(spark, sf_dir):
    """What the watermark shut out: old posts of the second part."""
    return read_late(spark, _counted_once(spark, sf_dir)).select("message_id")


def _windows(spark, sf_dir, of) -> DataFrame:
    """Posts in four parts by their time; half of each part comes with the next one."""
    posts = _text_posts(spark, sf_dir)
    year = F.year(F.col("tweet_time").cast("timestamp")) + (F.col("tweetid").cast("bigint") % 2)
    messages = posts.select(F.to_json(F.struct(*posts.columns)).alias("value"), year.alias("n"))
    table, checkpoint = new_folder(spark, "windows"), new_folder(spark, "checkpoint")
    _in_parts(
        spark, messages, [F.col("n") <= 1995, F.col("n") == 1996, F.col("n").between(1997, 1998), F.col("n") > 1998],
        lambda source: windows.start_writing(
            of(windows.timed_posts(source, "800 days")), table, checkpoint, {"availableNow": True}
        ),
    )
    return spark.read.parquet(table)


@query
def stream_hashtag_windows(spark, sf_dir):
    found = _windows(spark, sf_dir, lambda p: windows.term_windows(p, "hashtag", "28 days", "7 days"))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@query
def stream_account_sessions(spark, sf_dir):
    found = _windows(spark, sf_dir, lambda p: windows.account_sessions(p, "45 days"))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("session_start", "session_end")})
