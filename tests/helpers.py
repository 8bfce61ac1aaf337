from datetime import datetime

from meterflow import schemas


def ts(s: str) -> datetime:
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in s else "%Y-%m-%d %H:%M:%S"
    return datetime.strptime(s, fmt)


def cdr_data(spark, rows):
    """rows: (msisdn, tower, up, down, type, time)"""
    return spark.createDataFrame(
        [(m, t, u, d, ty, "1.1.1.1", "http://x", ts(x)) for m, t, u, d, ty, x in rows], schemas.CDR_DATA)


def cdr_voice(spark, rows):
    """rows: (msisdn, tower, call_type, seconds, time)"""
    return spark.createDataFrame(
        [(m, t, c, "2700000000", s, ts(x)) for m, t, c, s, x in rows], schemas.CDR_VOICE)


def empty_voice(spark):
    return spark.createDataFrame([], schemas.CDR_VOICE)


def empty_data(spark):
    return spark.createDataFrame([], schemas.CDR_DATA)
