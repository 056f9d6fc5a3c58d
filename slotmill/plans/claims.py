"""Claims on file ids while they are loaded, so that two loads of one id do not run at once."""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date
from urllib.parse import quote

from pyspark.sql import SparkSession

from slotmill.errors import FileClaimed
from slotmill.sources import storage
from slotmill.sources.loaded import day_folder

#: below the table in a folder that readers pass over
CLAIMS = "_claims"
#: age at which a claim is taken for one of a load that died
CLAIM_HOURS = 1.0


@contextmanager
def claimed(
    spark: SparkSession, target: str, import_date: date, ids: Iterable[str], owner: str, hours: float = CLAIM_HOURS
) -> Iterator[None]:
    """Hold a claim on each (import date, file id), or raise ``FileClaimed`` and hold none.

    A claim is a file that only one can create. It is given back at the end, whatever happened. One that
    its owner left, as a stream does whose batch is repeated after a crash, is taken up again by that
    owner, and one older than ``hours`` by anybody. Should its load still run, both load into folders
    of their own and the one that registers last counts, as a whole.
    """
    folder = day_folder(f"{target}/{CLAIMS}", import_date)
    held: list[str] = []

    def take(file_id: str) -> str | None:
        place = f"{folder}/{quote(file_id, safe='')}"
        for _ in range(2):
            if storage.create_once(spark, place, owner):
                held.append(place)
                return None
            found = storage.read_text(spark, place)
            if found is None:
                continue  # given back meanwhile
            if found[0] == owner:
                held.append(place)
                return None
            if time.time() - found[1] < hours * 3600:
                return f"{file_id} is being loaded by {found[0]}"
            storage.remove(spark, place)
        return f"{file_id} is being loaded"

    with ThreadPoolExecutor(storage.THREADS) as pool:
        try:
            refused = [r for r in pool.map(take, sorted(set(ids))) if r]
            if refused:
                raise FileClaimed("; ".join(refused[:5]))
            yield
        finally:
            list(pool.map(lambda place: storage.remove(spark, place), held))


def release_claims(spark: SparkSession, target: str, import_date: date) -> None:
    """Give back all claims of a day, for an operator who knows that their loads are gone."""
    storage.remove(spark, day_folder(f"{target}/{CLAIMS}", import_date))
