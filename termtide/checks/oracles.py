"""Oracle SQL of the registered queries, for an engine other than Spark."""

from ..functions.accounts import LANGUAGES
from ..functions.text import HANDLE, HASHTAG, NOISE, RETWEET, SIZES, STOP_WORDS, URL
from ..operators.leaders import NUMBERS, PACKED, PROFILE
from ..schemas import COUNTS, MESSAGE_FIELDS, POST_TYPES, RAW_POST_COLUMNS, RAW_USER_COLUMNS
from . import adapters
from .adapters import for_oracle

SIZE_NAMES = {2: "bigrams", 3: "trigrams", 4: "fourgrams", 5: "fivegrams"}
PACK_SEPARATOR = "chr(9) || ',' || chr(9)"
PLAIN_MONTH = "strftime(tweet_time, '%m-%Y')"
# The year of the Saturday that ends the week; dayofweek counts from Sunday = 0.
WEEK_MONTH = (
    "strftime(tweet_time, '%m') || '-' || "
    "strftime(cast(tweet_time as date) + cast(6 - dayofweek(tweet_time) as integer), '%Y')"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(quoted(w) for w in STOP_WORDS) + "]"
SUMS = ", ".join(f"cast(sum({c}) as bigint) as total_{c}" for c in COUNTS)
ENGAGEMENT = "cast(sum(" + " + ".join(COUNTS) + ") as bigint) as total_engagement_count"


def parsed_list(column: str) -> str:
    return (
        f"case when {column} not in ('[]', '') then "
        f"string_split(regexp_replace({column}, '[\\[\\]]', '', 'g'), ', ') end"
    )


def cleaned(pattern: str = NOISE, text: str = "tweet_text") -> str:
    return f"regexp_replace(lower({text}), {quoted(pattern)}, '', 'g')"


def tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\W'), lambda w: w <> '')"


def content_words(text: str = "tweet_text") -> str:
    return (
        f"list_filter({tokens(cleaned(text=text))}, "
        f"lambda w: not list_contains({STOP_LIST}, w))"
    )


def grams(words: str, n: int) -> str:
    return (
        f"list_transform(range(1, len({words}) - {n} + 2), "
        f"lambda i: array_to_string({words}[i:i + {n - 1}], ' '))"
    )


class Steps:
    """Named steps put in front of a final select."""

    def __init__(self, *steps: tuple[str, str]):
        self.steps = steps

    def __add__(self, other: "Steps") -> "Steps":
        return Steps(*self.steps, *other.steps)

    def select(self, final: str) -> str:
        return "with " + ",\n".join(f"{n} as ({s})" for n, s in self.steps) + "\n" + final


def step(name: str, sql: str) -> Steps:
    return Steps((name, sql))


POSTS = step("listed", for_oracle(adapters.POSTS)) + step(
    "posts", f"select * replace ({parsed_list('hashtags')} as hashtags) from listed"
)
EDITED_POSTS = step("listed", for_oracle(adapters.EDITED_POSTS)) + Steps(POSTS.steps[-1])
USERS = step("users", for_oracle(adapters.USERS))
RAW_POSTS = step("raw_posts", for_oracle(adapters.RAW_POSTS))
RAW_USERS = step("raw_users", for_oracle(adapters.RAW_USERS))


def normalized(column: str, kind: str) -> str:
    if kind == "array<string>":
        return f"{parsed_list(column)} as {column}"
    return f"try_cast(nullif({column}, '') as {kind}) as {column}"


CLEAN_POSTS = RAW_POSTS + step(
    "posts", "select " + ", ".join(normalized(c, t) for c, t in POST_TYPES.items())
    + " from raw_posts"
)

# Calendar months, English, text and time present.
ENGLISH = step(
    "english",
    f"select {PLAIN_MONTH} as tweet_month, * from posts where tweet_language = 'en' "
    "and tweet_text is not null and tweet_time is not null",
)
_CARRIED = "tweet_month, userid, tweet_client_name, " + ", ".join(COUNTS)


def ngram_rows(sizes=SIZES) -> Steps:
    parts = [f"select {_CARRIED}, unnest({grams('words', n)}) as ngram from worded" for n in sizes]
    return (
        ENGLISH
        + step("worded", f"select {_CARRIED}, {content_words()} as words from english")
        + step("ngram_rows", " union all ".join(parts))
    )


HASHTAG_ROWS = ENGLISH + step(
    "hashtag_rows",
    f"select * from (select {_CARRIED}, lower(unnest(hashtags)) as hashtag from english) "
    "where hashtag <> ''",
)
ROWS = {"ngram": ngram_rows(), "hashtag": HASHTAG_ROWS}


# Uses of every n-gram, its words but the last and but the first.
USES = step(
    "uses",
    "select *, len(string_split(ngram, ' ')) as size, array_to_string(string_split(ngram, ' ')[:-2], ' ') as front, "
    "array_to_string(string_split(ngram, ' ')[2:], ' ') as back "
    "from (select ngram, count(*) as count from ngram_rows group by ngram)",
)


def by_month(term: str, where: str = "true", name: str = "by_month", zero: bool = False) -> Steps:
    sums = SUMS
    if zero:
        sums = ", ".join(f"cast(coalesce(sum({c}), 0) as bigint) as total_{c}" for c in COUNTS)
    return step(
        name,
        f"select tweet_month, {term}, count(*) as count, {sums} from {term}_rows "
        f"where {where} group by all",
    )


def by_user(term: str, name: str = "by_user") -> Steps:
    return step(
        name,
        f"select {term}, userid, count(*) as count, {ENGAGEMENT}, {SUMS} from {term}_rows "
        "group by all",
    )


def leaders(term: str, prefix: str = "") -> Steps:
    """Steps `top` (ranked accounts) and `info` (with profiles)."""
    return (
        by_user(term, f"{prefix}by_user")
        + step(
            f"{prefix}top",
            f"select * from (select *, row_number() over (partition by {term} "
            "order by total_engagement_count desc nulls last, userid) as rank "
            f"from {prefix}by_user) where rank <= 5",
        )
        + step(
            f"{prefix}info",
            f"select {term}, rank, {', '.join(PROFILE)}, count, {', '.join(NUMBERS)} "
            f"from {prefix}top top join users on top.userid is not distinct from users.user_id",
        )
    )


def packed(term: str) -> Steps:
    lists = ", ".join(
        f"string_agg(coalesce(cast({c} as varchar), ''), {PACK_SEPARATOR} order by rank) "
        f"as {PACKED[c]}"
        for c in [*PROFILE, *NUMBERS]
    )
    return step("packed", f"select {term}, {lists} from info group by {term}")


def display_user() -> str:
    hashed = "length(user_display_name) = 64 and length(user_screen_name) = 64"
    return (
        f"case when {hashed} then '<Redacted>' else user_display_name end as display_name, "
        f"case when {hashed} then '<Redacted>' else user_screen_name end as handle"
    )


# Parents of posts, and the chain of each one up to the last that is there.
CASCADES = CLEAN_POSTS + step(
    "parents",
    "select p.tweetid, q.tweetid as up from posts p left join posts q on q.tweetid = "
    "coalesce(p.retweet_tweetid, p.quoted_tweet_tweetid, p.in_reply_to_tweetid)",
) + step(
    "chains",
    "select tweetid, tweetid as top, cast(0 as bigint) as depth from parents "
    "union all select c.tweetid, p.up, c.depth + 1 from chains c join parents p on p.tweetid = c.top "
    "where p.up is not null",
) + step("roots", "select tweetid, arg_max(top, depth) as root, max(depth) as depth from chains group by tweetid")


# The two-state automaton month by month: costs of both states, and the states before them.
BURSTS = POSTS + HASHTAG_ROWS + step(
    "uses",
    "select hashtag, datediff('month', date '1970-01-01', cast(tweet_time as date)) as m, count(*) as n "
    "from (select hashtag, strptime('01-' || tweet_month, '%d-%m-%Y') as tweet_time from hashtag_rows) group by all",
) + step(
    "shares", "select hashtag, sum(n) / (select sum(n) from uses) as low from uses group by hashtag"
) + step(
    "months",
    "select m, coalesce((select sum(n) from uses u where u.m = r.m), 0) as d "
    "from range((select min(m) from uses), (select max(m) + 1 from uses)) as r(m)",
) + step(
    "grid",
    "select s.hashtag, g.m - (select min(m) from uses) as i, "
    "- coalesce(n, 0) * ln(low) - (d - coalesce(n, 0)) * ln(1 - low) as k0, "
    "- coalesce(n, 0) * ln(greatest(low, least(2 * low, 0.5))) "
    "- (d - coalesce(n, 0)) * ln(1 - greatest(low, least(2 * low, 0.5))) as k1 "
    "from shares s cross join months g left join uses u on u.hashtag = s.hashtag and u.m = g.m",
) + step(
    "folded",
    "select hashtag, i, k0 as c0, 1 + k1 as c1, '0' as p0, '1' as p1 from grid where i = 0 union all "
    "select g.hashtag, g.i, least(c0, c1) + k0, least(c1, c0 + 1) + k1, "
    "case when c0 <= c1 then p0 else p1 end || '0', case when c1 <= c0 + 1 then p1 else p0 end || '1' "
    "from folded f join grid g on g.hashtag = f.hashtag and g.i = f.i + 1",
)

# The texts a list of phrases is made of: every two-word phrase of the benchmark items and
# the hashtag of every document source.
PHRASES = step(
    "phrases",
    "select distinct phrase from (select unnest("
    + grams("words", 2)
    + f") as phrase from (select {content_words('text')} as words from benchmark) "
    "union all select '#' || upper(source) as phrase from documents)",
)
ROUTED = step(
    "routed",
    "select phrase, case when phrase like '#%' then 'hashtag' else 'ngram' end as kind, "
    "lower(case when phrase like '#%' then phrase[2:] else phrase end) as term from phrases",
)
SERIES_COLUMNS = (
    "count, coalesce(total_like_count, 0) as likes, coalesce(total_quote_count, 0) as quotes, "
    "coalesce(total_reply_count, 0) as replies, coalesce(total_retweet_count, 0) as retweets"
)
USER_COLUMNS = (
    f"rank, {display_user()}, coalesce(user_profile_description, '') as bio, "
    "coalesce(user_reported_location, '') as location, "
    "total_engagement_count as engagement, total_retweet_count as retweets, "
    "total_like_count as likes, total_quote_count as quotes, total_reply_count as replies"
)
# The feed whose posts reach the merge queries through the stream.
STREAMED = "tweet_client_name >= 'src5'"
MONTH_KEYS = "tweet_month, count, " + ", ".join(f"total_{c}" for c in COUNTS)


def merged(term: str, how: str) -> str:
    both = (
        (POSTS + ROWS[term])
        + by_month(term, f"not ({STREAMED})", "batch")
        + by_month(term, STREAMED, "speed")
    )
    added = ", ".join(
        f"coalesce(b.{c}, 0) + coalesce(s.{c}, 0) as {c}"
        for c in ["count", *[f"total_{c}" for c in COUNTS]]
    )
    return both.select(
        f"select {term}, tweet_month, {added} from batch b {how} join speed s "
        f"using ({term}, tweet_month)"
    )


def views(term: str, final: str) -> str:
    return (POSTS + USERS + ROWS[term] + leaders(term) + packed(term)).select(final)


def month_view(term: str, final: str) -> str:
    return (POSTS + ROWS[term] + by_month(term)).select(final)


def counters(term: str) -> str:
    return (POSTS + ROWS[term] + by_month(term, zero=True)).select("select * from by_month")


def stream_messages() -> Steps:
    """Posts by what becomes of their message."""
    return POSTS + step(
        "messages",
        "select *, case when cast(tweetid as bigint) % 13 = 0 then 'malformed' "
        "when cast(tweetid as bigint) % 17 = 0 then 'missing: tweet_time' "
        "when cast(tweetid as bigint) % 19 = 0 then 'malformed: tweet_time' end as reason "
        "from posts",
    )


# Of the second part of a stream, what is 1000 days or more older than the newest of the first.
LATE = (
    "tweet_time <= (select max(tweet_time) from posts where cast(tweetid as bigint) % 3 = 0) "
    "- interval 1000 day"
)
# A stream's last watermark; windows that end later are still open.
CLOSED = (
    "(select max(tweet_time) from posts where tweet_language = 'en' and tweet_text is not null) "
    "- interval 800 day"
)


def counted_once() -> str:
    """The first part whole, and of the second part what is not late."""
    once = step("once", f"select * from posts where cast(tweetid as bigint) % 3 = 0 or not ({LATE})")
    rows = [(n, s.replace("from posts", "from once")) for n, s in ROWS["ngram"].steps]
    return (POSTS + once + Steps(*rows) + by_month("ngram", zero=True)).select("select * from by_month")


def hashtag_windows() -> str:
    """Each use lies in four windows; they begin on Thursdays, as the epoch did."""
    return (
        POSTS + step(
            "uses",
            f"select lower(unnest(hashtags)) as hashtag, tweet_time, {', '.join(COUNTS)} from posts "
            "where tweet_language = 'en' and tweet_text is not null",
        ) + step(
            "placed",
            "select *, time_bucket(interval 7 day, tweet_time, timestamp '1970-01-01') "
            "- to_days(cast(7 * k as integer)) as opens from uses, range(4) as r(k) where hashtag <> ''",
        )
    ).select(
        "select strftime(opens, '%Y-%m-%d %H:%M:%S') as window_start, "
        "strftime(opens + interval 28 day, '%Y-%m-%d %H:%M:%S') as window_end, hashtag, count(*) as count, "
        + ", ".join(f"cast(coalesce(sum({c}), 0) as bigint) as total_{c}" for c in COUNTS)
        + f" from placed where opens + interval 28 day <= {CLOSED} group by opens, hashtag"
    )


def account_sessions() -> str:
    whole = " + ".join(f"coalesce({c}, 0)" for c in COUNTS)
    return (
        POSTS + step(
            "marked",
            f"select userid, tweet_time, {whole} as engagement, "
            "coalesce(tweet_time >= lag(tweet_time) over w + interval 45 day, true) as opens from posts "
            "where tweet_language = 'en' and tweet_text is not null and userid is not null "
            "window w as (partition by userid order by tweet_time)",
        ) + step(
            "numbered",
            "select *, sum(cast(opens as integer)) over (partition by userid order by tweet_time) as session from marked",
        )
    ).select(
        "select userid, strftime(min(tweet_time), '%Y-%m-%d %H:%M:%S') as session_start, "
        "strftime(max(tweet_time) + interval 45 day, '%Y-%m-%d %H:%M:%S') as session_end, count(*) as posts, "
        "cast(sum(engagement) as bigint) as total_engagement_count from numbered group by userid, session "
        f"having max(tweet_time) + interval 45 day <= {CLOSED}"
    )


def recursive(sql: str) -> str:
    return sql.replace("with ", "with recursive ", 1)


def text_query(expression: str, name: str) -> str:
    return POSTS.select(f"select tweetid, {expression} as {name} from posts")


def oracle_sql() -> dict[str, str]:
    number_totals = ", ".join(NUMBERS)
    raw = ", ".join(f"nullif({c}, '') as {c}" for c in RAW_POST_COLUMNS)
    raw_users = ", ".join(f"nullif({c}, '') as {c}" for c in RAW_USER_COLUMNS)
    flat_posts = ", ".join(
        f"array_to_string({c}, '|') as {c}" if t == "array<string>"
        else f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" if t == "timestamp" else c
        for c, t in POST_TYPES.items()
    )
    language = " ".join(f"when {quoted(c)} then {quoted(n)}" for c, n in LANGUAGES.items())
    language = f"case account_language {language} end"
    created = "try_cast(account_creation_date as date)"
    parts = (
        f"cast(year({created}) as smallint) as account_creation_year, "
        f"cast(month({created}) as tinyint) as account_creation_month, "
        f"cast(day({created}) as tinyint) as account_creation_day"
    )
    hashed_users = step("users", for_oracle(adapters.HASHED_USERS))
    lists = ["hashtags", "urls", "user_mentions", "poll_choices"]
    scalars = [c for c, t in POST_TYPES.items() if t == "string"]
    casts = [c for c, t in POST_TYPES.items() if t in ("int", "double", "boolean")]
    routed_views = {
        "month": "select phrase, tweet_month as month, " + SERIES_COLUMNS
        + " from routed join by_{0} on kind = '{0}' and term = {0}",
    }

    sql = {
        # Sources and sinks.
        "posts_csv_scan": RAW_POSTS.select(f"select {raw} from raw_posts"),
        "users_csv_scan": RAW_USERS.select(f"select {raw_users} from raw_users"),
        "posts_normalized": CLEAN_POSTS.select(f"select {flat_posts} from posts"),
        "users_dim": RAW_USERS.select(
            "select userid as user_id, user_display_name, user_screen_name, "
            "nullif(user_reported_location, '') as user_reported_location, "
            "nullif(user_profile_description, '') as user_profile_description, "
            "nullif(user_profile_url, '') as user_profile_url, "
            "case when follower_count = '' then 0 else try_cast(follower_count as integer) end "
            "as follower_count, "
            "case when following_count = '' then 0 else try_cast(following_count as integer) end "
            f"as following_count, {parts}, {language} as account_language from raw_users"
        ),
        "users_rejects": RAW_USERS.select(
            "select field, count(*) as rows from (select unnest(["
            f"case when {created} is null then 'account_creation_year' end, "
            f"case when {language} is null then 'account_language' end]) as field from raw_users) "
            "where field is not null group by field"
        ),
        "sink_roundtrip_append": (POSTS + ROWS["ngram"] + by_month("ngram")).select(
            "select * from by_month"
        ),
        "sink_roundtrip_overwrite": month_view("hashtag", "select * from by_month"),
        "csv_to_json_messages": RAW_POSTS.select(f"select {', '.join(RAW_POST_COLUMNS)} from raw_posts"),
        "parse_json_messages": RAW_POSTS.select(
            f"select tweetid, {', '.join(MESSAGE_FIELDS)} from raw_posts"
        ),
        # Clean-up.
        "posts_english": POSTS.select(
            f"select {PLAIN_MONTH} as tweet_month, tweet_text, userid, "
            f"array_to_string(hashtags, '|') as hashtags, {', '.join(COUNTS)} from posts "
            "where tweet_language = 'en' and tweet_text is not null and tweet_time is not null"
        ),
        "normalize_blank_to_null": CLEAN_POSTS.select(f"select {', '.join(scalars)} from posts"),
        "normalize_lists": CLEAN_POSTS.select(
            "select tweetid, "
            + ", ".join(f"{c} is null as {c}_null, len({c}) as {c}_size" for c in lists)
            + " from posts"
        ),
        "normalize_casts": CLEAN_POSTS.select(
            f"select tweetid, {', '.join(casts)}, "
            "strftime(tweet_time, '%Y-%m-%d %H:%M:%S') as tweet_time from posts"
        ),
        "parse_list_column": RAW_POSTS.select(
            f"select tweetid, unnest({parsed_list('hashtags')}) as item from raw_posts"
        ),
        "explode_hashtags": POSTS.select(
            "select tweetid, unnest(hashtags) as hashtag from posts"
        ),
        "hashtags_nonblank": CLEAN_POSTS.select(
            "select hashtag, count(*) as uses from (select lower(unnest(hashtags)) as hashtag "
            "from posts) where hashtag <> '' group by hashtag"
        ),
        "month_bucket": POSTS.select(f"select tweetid, {PLAIN_MONTH} as tweet_month from posts"),
        "month_bucket_weekyear": POSTS.select(
            f"select tweetid, {WEEK_MONTH} as tweet_month from posts"
        ),
        # Text.
        "clean_text": text_query(cleaned(), "text"),
        "clean_text_url": text_query(cleaned(URL), "text"),
        "clean_text_retweet": text_query(cleaned(RETWEET), "text"),
        "clean_text_handle": text_query(cleaned(HANDLE), "text"),
        "clean_text_hashtag": text_query(cleaned(HASHTAG), "text"),
        "tokenize": text_query(f"array_to_string({tokens(cleaned())}, ' ')", "tokens"),
        "remove_stopwords": text_query(f"array_to_string({content_words()}, ' ')", "tokens"),
        # Rankings and lists.
        "engagement_null_semantics": POSTS.select(
            "select userid, "
            f"{ENGAGEMENT}, "
            "cast(sum(" + " + ".join(f"coalesce({c}, 0)" for c in COUNTS) + ") as bigint) "
            "as with_missing_as_zero from posts group by userid"
        ),
        # Account versions, phrases and completions.
        "profiles_as_of": (POSTS + step("versions", for_oracle(adapters.ACCOUNT_VERSIONS))).select(
            "select tweetid, userid, strftime(tweet_time, '%Y-%m-%d %H:%M:%S') as tweet_time, tweet_client_name, "
            "user_display_name, user_profile_description "
            "from posts asof left join versions on userid = user_id and tweet_time >= valid_from"
        ),
        "maximal_phrases": (POSTS + ROWS["ngram"] + USES + step(
            "inside",
            "select ngram, max(count) as most from (select front as ngram, count from uses where size > 2 "
            "union all select back, count from uses where size > 2) group by ngram",
        )).select(
            "select u.ngram, count from uses u left join inside i on i.ngram = u.ngram "
            "where most is null or most < count"
        ),
        "collocations": (POSTS + ngram_rows([2]) + step(
            "pairs",
            "select split_part(ngram, ' ', 1) as word_1, split_part(ngram, ' ', 2) as word_2, "
            "count(*) as count from ngram_rows group by all",
        ) + step(
            "margins",
            "select *, cast(sum(count) over (partition by word_1) as bigint) as count_1, "
            "cast(sum(count) over (partition by word_2) as bigint) as count_2, "
            "cast(sum(count) over () as bigint) as total from pairs",
        )).select(
            "select *, round(2 * list_sum(list_transform([[count, count_1 * count_2 / total], "
            "[count_1 - count, count_1 * (total - count_2) / total], "
            "[count_2 - count, (total - count_1) * count_2 / total], "
            "[total - count_1 - count_2 + count, (total - count_1) * (total - count_2) / total]], "
            "lambda c: case when c[1] > 0 then c[1] * ln(c[1] / c[2]) else 0 end)), 4) as log_likelihood "
            "from margins"
        ),
        "type_ahead": (POSTS + ROWS["ngram"] + USES + step(
            "prefixes",
            "select distinct left(word, 3) as prefix from "
            f"(select unnest({content_words('text')}) as word from benchmark)",
        )).select(
            "select * from (select prefix, cast(row_number() over (partition by prefix order by count desc, ngram) "
            "as integer) as place, ngram as term, count from prefixes join (select *, left(ngram, k) as start "
            "from uses, range(1, 4) as r(k)) on start = prefix and length(prefix) = k) where place <= 5"
        ),
        "accounts_estimated": (POSTS + ROWS["hashtag"]).select(
            "select hashtag, count(distinct userid) as accounts, true as close from hashtag_rows group by hashtag"
        ),
        "hashtag_bursts": recursive(BURSTS.select(
            "select hashtag, strftime(date '1970-01-01' + to_months(cast((select min(m) from uses) as integer)), '%m-%Y') "
            "as first_month, case when c0 <= c1 then p0 else p1 end as states, round(least(c0, c1), 4) as cost "
            "from folded where i = (select max(i) from grid)"
        )),
        "cascade_roots": recursive(CASCADES.select("select * from roots")),
        "cascade_sums": recursive(CASCADES.select(
            "select root, count(*) as posts, max(depth) as depth, "
            + ", ".join(f"cast(sum({c}) as bigint) as total_{c}" for c in COUNTS)
            + " from posts join roots using (tweetid) group by root"
        )),
        # Changes.
        "top_users_after_delta": views("ngram", "select * from info"),
        "views_after_retraction": (EDITED_POSTS + ROWS["ngram"] + by_month("ngram")).select(
            "select * from by_month"
        ),
        "accounts_after_retraction": (EDITED_POSTS + ROWS["ngram"] + by_user("ngram")).select(
            "select * from by_user"
        ),
        "leaders_after_retraction": (
            EDITED_POSTS + USERS + ROWS["hashtag"] + leaders("hashtag")
        ).select(f"select hashtag, userid, rank, count, {number_totals} from top"),
        # Lookups.
        "split_serving_key": month_view(
            "ngram",
            "select distinct ngram || '_' || tweet_month as key, ngram as term, "
            "tweet_month as month from by_month",
        ),
        "user_created_parts": RAW_USERS.select(
            f"select userid, strftime({created}, '%Y-%m-%d') as created, {parts} from raw_users"
        ),
        "user_language_name": RAW_USERS.select(
            f"select userid, account_language as code, {language} as name from raw_users"
        ),
        "redact_hashed_users": hashed_users.select(
            f"select user_id, {display_user()} from users"
        ),
        "format_counts": (POSTS + HASHTAG_ROWS + by_user("hashtag")).select(
            "select hashtag, userid, "
            + ", ".join(f"format('{{:,}}', {c}) as {c}" for c in NUMBERS)
            + " from by_user"
        ),
        "lookup_routed": (PHRASES + ROUTED).select("select * from routed"),
        "lookup_by_month": month_view(
            "hashtag",
            f"select '#src1' as phrase, tweet_month as month, {SERIES_COLUMNS} from by_month "
            "where hashtag = 'src1'",
        ),
        "lookup_top_users": views(
            "hashtag",
            f"select '#src1' as phrase, {USER_COLUMNS} from (select * replace "
            "(row_number() over (order by rank) as rank) from info where hashtag = 'src1')",
        ),
        "lookup_series_ordered": (
            PHRASES + ROUTED + POSTS + ROWS["ngram"] + by_month("ngram", name="by_ngram")
            + step("hashtag_rows", HASHTAG_ROWS.steps[-1][1])
            + by_month("hashtag", name="by_hashtag")
        ).select(" union all ".join(
            "select phrase, tweet_month as month, row_number() over (partition by phrase "
            "order by strptime('01-' || tweet_month, '%d-%m-%Y') desc) as position, count "
            f"from routed join by_{k} on kind = '{k}' and term = {k}"
            for k in ("ngram", "hashtag")
        )),
        "lookup_merged": merged("hashtag", "left"),
        "lookup_after_rebuild": month_view(
            "hashtag",
            f"select '#src7' as phrase, tweet_month as month, {SERIES_COLUMNS} from by_month "
            "where hashtag = 'src7'",
        ),
        "counters_after_compaction": (
            POSTS + ROWS["hashtag"] + by_month("hashtag", STREAMED, "speed", zero=True)
        ).select("select * from speed"),
        "merge_views_full": merged("ngram", "full"),
        "lookup_levelled_counters": (
            PHRASES + ROUTED + POSTS + ROWS["ngram"] + by_month("ngram", zero=True)
        ).select(
            "select * from by_month where ngram in (select term from routed where kind = 'ngram')"
        ),
        "lookup_many": (
            PHRASES + ROUTED + POSTS + ROWS["ngram"] + by_month("ngram", name="by_ngram")
            + step("hashtag_rows", HASHTAG_ROWS.steps[-1][1])
            + by_month("hashtag", name="by_hashtag")
        ).select(" union all ".join(routed_views["month"].format(k) for k in ("ngram", "hashtag"))),
        "lookup_many_users": (
            PHRASES + ROUTED + POSTS + USERS + ROWS["ngram"] + leaders("ngram", "ngram_")
            + step("hashtag_rows", HASHTAG_ROWS.steps[-1][1]) + leaders("hashtag", "hashtag_")
        ).select(" union all ".join(
            f"select phrase, {USER_COLUMNS} from (select * replace (row_number() over "
            f"(partition by {k} order by rank) as rank) from {k}_info) "
            f"join routed on kind = '{k}' and term = {k}"
            for k in ("ngram", "hashtag")
        )),
        # Stream.
        "stream_posts_count": POSTS.select(
            "select tweet_language, count(*) as posts from posts group by tweet_language"
        ),
        "stream_ngram_counters": counters("ngram"),
        "stream_hashtag_counters": counters("hashtag"),
        "stream_counted_once": counted_once(),
        "stream_late_messages": POSTS.select(
            f"select tweetid as message_id from posts where {LATE}"
        ),
        "stream_hashtag_windows": hashtag_windows(),
        "stream_account_sessions": account_sessions(),
        "stream_dead_letter": stream_messages().select(
            "select reason, count(*) as messages from messages where reason is not null "
            "group by reason"
        ),
    }
    for n, name in SIZE_NAMES.items():
        sql[name] = POSTS.select(
            f"select tweetid, unnest({grams('words', n)}) as ngram "
            f"from (select tweetid, {content_words()} as words from posts)"
        )
        sql[f"{name}_by_month"] = (POSTS + ngram_rows([n]) + by_month("ngram")).select(
            "select * from by_month"
        )
    for term in ROWS:
        sql |= {
            f"{term}s_by_month": month_view(term, "select * from by_month"),
            f"{term}s_by_user": views(term, "select * from by_user"),
            f"top_users_by_{term}": views(term, "select * from top"),
            f"{term}_top_users_info": views(term, "select * from info"),
            f"{term}_top_users_packed": views(term, "select * from packed"),
            f"publish_{term}s_by_month": month_view(
                term, f"select {term} || '_' || tweet_month as key, * from by_month"
            ),
            f"publish_{term}s_top_users": views(term, "select * from packed"),
        }
    sql["unpack_top_users"] = views(
        "hashtag",
        "select hashtag, row_number() over (partition by hashtag order by rank) as rank, "
        + ", ".join(f"coalesce({c}, '') as {c}" for c in PROFILE)
        + f", {number_totals} from info",
    )
    return sql
