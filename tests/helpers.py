"""Small shared inputs."""

from datetime import datetime, timedelta

DAY = datetime(2020, 1, 1)


def days(count, start=DAY):
    return [start + timedelta(days=i) for i in range(count)]


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).collect()]
