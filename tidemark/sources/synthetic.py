"""Generated users and events, the same for the same seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import events as E

#: Fixed values of the generated rows.
EVENTS = ("pause", "like", "skip", "rate", "complete")
DEVICES = ("ios", "android", "web")
GENDERS = ("male", "female", "other")
NAMES = ("Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gia", "Hal")
SURNAMES = ("Abel", "Berg", "Cole", "Dunn", "Eads", "Frey", "Gale", "Hart")
FIRST_BIRTH, LAST_BIRTH = "1950-01-01", "2007-12-31"
LEAST_USERS, BUCKET_MINUTES, MOST_SECONDS = 30, 10, 3600


def _draw(seed: int, salt: str, n: int | Column, *keys: Column) -> Column:
    """A number under n, by 32 bits of a digest that other engines have too."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.lit(salt), *keys))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(n) if isinstance(n, int) else n).cast("int")


def _order(seed: int, key: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.col(key)))


def _pick(values: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at)


def users(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """id (in the form of a uuid), name, surname, date_of_birth and gender of n users."""
    key = F.col("n")
    digest = F.md5(F.concat_ws("|", F.lit(seed), key))
    uuid = F.concat_ws("-", *(F.substring(digest, a, m) for a, m in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    days = F.datediff(F.lit(LAST_BIRTH).cast("date"), F.lit(FIRST_BIRTH).cast("date")) + 1
    born = F.date_add(F.lit(FIRST_BIRTH).cast("date"), _draw(seed, "born", days, key))
    return spark.range(n).toDF("n").select(
        uuid.alias("id"),
        _pick(NAMES, _draw(seed, "name", len(NAMES), key)).alias("name"),
        _pick(SURNAMES, _draw(seed, "surname", len(SURNAMES), key)).alias("surname"),
        F.date_format(born, "yyyy-MM-dd").alias("date_of_birth"),
        _pick(GENDERS, _draw(seed, "gender", len(GENDERS), key)).alias("gender"),
    )


def events(people: DataFrame, episodes: list[str], now: str, seed: int = 1) -> DataFrame:
    """One event in the present bucket of each of at least LEAST_USERS people (all, if they are fewer).

    people has id; now is a time in UTC. The number of people is drawn first, then who they are.
    """
    n = people.count()
    least = min(LEAST_USERS, n)
    size = least + people.sparkSession.range(1).select(_draw(seed, "size", n - least + 1, F.lit(n))).first()[0] if n else 0
    chosen = people.select(F.col("id").alias("user_id")).orderBy(_order(seed, "user_id"), "user_id").limit(size)
    user, ts = F.col("user_id"), F.lit(now).cast("timestamp")
    bucket = E.iso_utc(E.bucket_start(ts, BUCKET_MINUTES))
    event = _pick(EVENTS, _draw(seed, "event", len(EVENTS), user))
    out = chosen.select(
        E.event_id(user, bucket).alias("event_id"),
        user,
        _pick(tuple(episodes), _draw(seed, "episode", len(episodes), user)).alias("episode_id"),
        event.alias("event"),
        _pick(DEVICES, _draw(seed, "device", len(DEVICES), user)).alias("device"),
        E.iso_utc(ts).alias("ts"),
        bucket.alias("bucket"),
    )
    at, other = _draw(seed, "at", MOST_SECONDS + 1, user), _draw(seed, "to", MOST_SECONDS + 1, user)
    kind = F.col("event")
    return out.withColumns(
        {
            "rating": F.when(kind == "rate", 1 + _draw(seed, "rating", 5, user)),
            "position_sec": F.when(kind == "pause", at),
            "from_sec": F.when(kind == "skip", F.least(at, other)),
            "to_sec": F.when(kind == "skip", F.greatest(at, other)),
            "played_pct": F.when(kind == "complete", F.lit(1.0)),
        }
    )


def sample(df: DataFrame, n: int, key: str, seed: int = 1) -> DataFrame:
    """n rows without replacement, the same for the same seed."""
    return df.orderBy(_order(seed, key), key).limit(n)
