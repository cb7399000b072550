"""A column through an external command: one process per task, one line per value."""

from __future__ import annotations

import subprocess
import sys
import threading
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Send this module along with the task, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _feed(stdin, values: list[str]) -> None:
    try:
        stdin.write("".join(f"{value}\n" for value in values))
        stdin.flush()
    except BrokenPipeError:
        pass  # the reader sees the missing answer


def pipe_numbers(rows: DataFrame, name: str, command: list[str], out: str | None = None,
                 chunk: int = 1000) -> DataFrame:
    """Replace a number column by what ``command`` prints for it (or add it as ``out``).

    The command must answer every input line ("%f") with one line as it comes, without
    waiting for more input or holding output back. It starts and ends with its task;
    ``chunk`` values are written ahead of reading, so the process is never idle between
    lines. NULLs are not sent.
    """
    target = out or name
    schema = T.StructType(
        [field for field in rows.schema.fields if field.name != target]
        + [T.StructField(target, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE,
                              text=True) as process:
            for batch in batches:
                table = pa.Table.from_batches([batch])
                values = table[name].to_pylist()
                sent = [f"{value:f}" for value in values if value is not None]
                answers = []
                for start in range(0, len(sent), chunk):
                    part = sent[start:start + chunk]
                    # Writing beside reading: neither pipe can fill up and block both ends.
                    writer = threading.Thread(target=_feed, args=(process.stdin, part))
                    writer.start()
                    for _ in part:
                        line = process.stdout.readline()
                        if not line:
                            raise RuntimeError(f"{command[0]} ended early")
                        answers.append(float(line))
                    writer.join()
                answered = iter(answers)
                column = pa.array([None if value is None else next(answered)
                                   for value in values], pa.float64())
                if target in table.column_names:
                    table = table.drop_columns([target])
                yield from table.append_column(target, column).to_batches()
            process.stdin.close()

    return rows.mapInArrow(run, schema)
