import csv

from termtide.schemas import RAW_POST_COLUMNS, RAW_USER_COLUMNS
from termtide.session import new_folder
from termtide.sources.posts import normalize_posts, scan_posts_csv
from termtide.sources.tables import save_table, write_table
from termtide.sources.users import scan_users_csv, user_rejects, users_dimension


def write_csv(path, header, *given):
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, header, restval="")
        out.writeheader()
        out.writerows(given)
    return str(path)


def test_posts_csv(spark, tmp_path):
    text = 'two\nlines, "quoted" text'
    path = write_csv(
        tmp_path / "p.csv", RAW_POST_COLUMNS,
        {"tweetid": "1", "tweet_text": text, "tweet_time": "2017-06-22 16:03", "like_count": "7",
         "hashtags": "[a, b]", "quoted_tweet_tweetid": "9", "is_retweet": "true"},
        {"tweetid": "2", "like_count": "many", "hashtags": "[]", "tweet_time": "never"},
    )
    one, two = normalize_posts(scan_posts_csv(spark, path)).orderBy("tweetid").collect()
    assert one["tweet_text"] == text and one["hashtags"] == ["a", "b"] and one["like_count"] == 7
    assert one["tweet_time"].isoformat() == "2017-06-22T16:03:00" and one["is_retweet"] is True
    assert one["quoted_tweet_tweetid"] == "9" and one["in_reply_to_tweetid"] is None
    assert two["tweet_text"] is None and two["like_count"] is None and two["hashtags"] is None
    assert two["tweet_time"] is None and len(one) == 22


def test_users_csv_in_any_column_order(spark, tmp_path):
    path = write_csv(
        tmp_path / "u.csv", ["extra", *reversed(RAW_USER_COLUMNS)],
        {"userid": "a", "account_language": "fr", "account_creation_date": "2014-03-02", "follower_count": "5"},
        {"userid": "b", "account_language": "xx", "account_creation_date": "?", "follower_count": "many"},
    )
    users = users_dimension(scan_users_csv(spark, path))
    good, bad = users.orderBy("user_id").collect()
    assert (good["account_creation_year"], good["account_creation_month"], good["account_creation_day"]) == (2014, 3, 2)
    assert good["account_language"] == "FRENCH" and good["following_count"] == 0
    assert bad["account_language"] is None and bad["follower_count"] is None
    rejects = {r["field"]: r["rows"] for r in user_rejects(users).collect()}
    lost = {"user_display_name": 2, "user_screen_name": 2}
    assert rejects == {**lost, "account_creation_year": 1, "account_language": 1, "follower_count": 1}


def test_users_csv_of_files_in_different_orders(spark, tmp_path):
    row = {c: c[:3] for c in RAW_USER_COLUMNS}
    write_csv(tmp_path / "a b.csv", RAW_USER_COLUMNS, {**row, "userid": "1"})
    write_csv(tmp_path / "b.csv", [*reversed(RAW_USER_COLUMNS)], {**row, "userid": "2"})
    write_csv(tmp_path / "c.csv", ["more", *RAW_USER_COLUMNS], {**row, "userid": ""})
    got = scan_users_csv(spark, str(tmp_path)).fillna("").collect()
    assert sorted(r["userid"] for r in got) == ["", "1", "2"]
    assert all(r[c] == c[:3] for r in got for c in RAW_USER_COLUMNS[1:])
    rejects = {r["field"]: r["rows"] for r in user_rejects(users_dimension(scan_users_csv(spark, str(tmp_path)))).collect()}
    assert rejects["user_id"] == 1


def test_append_and_overwrite(spark):
    path = new_folder(spark, "t")
    df = spark.range(3)
    for _ in range(2):
        write_table(df, path, "append", "orc")
    assert spark.read.orc(path).count() == 6
    assert write_table(df, path, "overwrite", "orc").count() == 3
    spark.sql("drop table if exists termtide_test")
    at = new_folder(spark, "named")
    save_table(df, "termtide_test", path=at)
    assert save_table(df, "termtide_test", "append", at).count() == 6
