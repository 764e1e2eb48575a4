"""Where tables come from and go to: registered parquet folders or JDBC sources, documents and settings files."""

from __future__ import annotations

import base64
import json
import os
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The tables of a translation store: columns and keys. Keys are kept unique by the transitions of operators.state.
SCHEMAS = {
    "translations": ("article_id long, rephrased_article_hi binary, rephrased_title_hi string, headline_verified_hi int", ["article_id"]),
    "event_translations": ("event_id long, title_hi string", ["event_id"]),
    "event_milestone_translations": ("event_id long, article_id long, milestone_hi string", ["event_id", "article_id"]),
    "translation_failures": ("article_id long, attempts long, last_error string", ["article_id"]),
    "event_failures": ("event_id long, attempts long, last_error string", ["event_id"]),
    "milestone_failures": ("event_id long, article_id long, attempts long, last_error string", ["event_id", "article_id"]),
}


def settings(lines: Iterable[str]) -> dict[str, str]:
    """key=value lines; blank lines, comments and lines without = are skipped, the last of a key counts."""
    pairs = (x.strip().split("=", 1) for x in lines if x.strip() and not x.strip().startswith("#") and "=" in x)
    return {k.strip(): v.strip() for k, v in pairs}


def load_settings(path: str) -> dict[str, str]:
    """A settings file's pairs, also put into the environment; none if there is no file."""
    found = settings(Path(path).read_text(encoding="utf-8").splitlines()) if os.path.exists(path) else {}
    os.environ.update(found)
    return found


def glossary(path: str) -> dict[str, str]:
    """A JSON glossary; empty if missing or broken."""
    try:
        return dict(json.loads(Path(path).read_text(encoding="utf-8")))
    except (OSError, ValueError):
        return {}


#: Changes that a table gathers before they are merged into its rows, and versions that are kept for readers.
MOST_CHANGES, KEPT = 20, 3


def open_store(spark: SparkSession, root: str, token: str = "") -> Store:
    """The store of a root: a JDBC URL, the https or libsql URL of an HTTP SQL server, or a folder."""
    root, token = root.strip().strip("\"'").rstrip("/"), token.strip().strip("\"'")
    kind = JdbcStore if root.startswith("jdbc:") else HttpStore if root.startswith(("https:", "http:", "libsql:")) else Store
    return kind(spark, root, token)


class Store:
    """Tables under one folder.

    A table is a folder of rows and a list of changes, each a folder of rows that replace those of their keys or of
    keys that go. A change touches nothing but its own rows, so a batch costs what the batch holds; readers leave the
    changed keys out of the rows and add the changes. After MOST_CHANGES they are merged. The list is a numbered file
    that is renamed into its place, which fails if another writer was first: a reader sees the old or the new state, a
    failed write leaves the old one, and a table may be computed from itself.
    """

    def __init__(self, spark: SparkSession, root: str, token: str = ""):
        self.spark, self.root, self.token = spark, root.strip().strip("\"'").rstrip("/"), token

    # the list of a table's folders

    def _fs(self, name: str) -> tuple[Any, Callable[..., Any]]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        folder = path(f"{self.root}/{name}")
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), lambda *parts: path("/".join([self.root, name, *parts]))

    def _numbers(self, name: str) -> list[int]:
        fs, path = self._fs(name)
        if not fs.exists(path("_lists")):
            return []
        found = [x.getPath().getName() for x in fs.listStatus(path("_lists"))]
        return sorted(int(x) for x in found if x.isdigit())

    def _list(self, name: str, number: int) -> dict[str, Any]:
        fs, path = self._fs(name)
        stream = fs.open(path("_lists", f"{number:012d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _put_list(self, name: str, before: list[int], value: dict[str, Any]) -> None:
        """The next list of a table; older ones than the last KEPT go, with the folders that only they name."""
        fs, path = self._fs(name)
        number = (before[-1] if before else 0) + 1
        own = path("_lists", f"_{uuid.uuid4().hex}")
        stream = fs.create(own, True)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        target = path("_lists", f"{number:012d}")
        if fs.exists(target) or not fs.rename(own, target):
            fs.delete(own, False)
            raise RuntimeError(f"{name} was changed by another writer")
        kept, old = [*before, number][-KEPT:], [*before, number][:-KEPT]
        named = {x for n in kept for x in self._folders(self._list(name, n))}
        for n in old:
            for x in set(self._folders(self._list(name, n))) - named:
                fs.delete(path(x), True)
            fs.delete(path("_lists", f"{n:012d}"), False)

    @staticmethod
    def _folders(value: dict[str, Any]) -> list[str]:
        return [value["rows"], *(x["rows"] for x in value["changes"])]

    def _saved(self, name: str, rows: DataFrame) -> str:
        version = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/{name}/{version}")
        return version

    # tables

    def exists(self, name: str) -> bool:
        return bool(self._numbers(name))

    def read(self, name: str) -> DataFrame:
        """A table; an empty one of the known schema if it was never written."""
        numbers = self._numbers(name)
        if not numbers:
            return self.spark.createDataFrame([], SCHEMAS[name][0])
        value = self._list(name, numbers[-1])
        rows, changes = self._part(name, value["rows"]), None
        for k, x in enumerate(value["changes"]):
            one = self._part(name, x["rows"])
            absent = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema if f.name not in one.columns}
            one = one.withColumns({**absent, "_n": F.lit(k), "_gone": F.lit(x["gone"])})
            changes = one if changes is None else changes.unionByName(one)
        if changes is None:
            return rows
        keys = value["keys"]
        # changes are few, as they are merged after MOST_CHANGES, but any size is right: the optimizer broadcasts them if small
        kept = rows.join(changes.select(*keys).distinct(), keys, "left_anti")
        others = [c for c in rows.columns if c not in keys]
        last = changes.groupBy(*keys).agg(F.max_by(F.struct("_gone", *others), "_n").alias("_last")).filter("not _last._gone")
        return kept.unionByName(last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others]))

    def _part(self, name: str, version: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/{version}")

    def write(self, name: str, rows: DataFrame) -> None:
        """rows in place of the table."""
        before = self._numbers(name)
        self._put_list(name, before, {"rows": self._saved(name, rows), "keys": [], "changes": []})

    def upsert(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        """rows, with the table's columns and unique keys, in place of those of their keys."""
        self._change(name, rows.select(*self.read(name).columns), keys, gone=False)

    def delete(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        """Without the rows of these keys."""
        self._change(name, rows.select(*keys).distinct(), keys, gone=True)

    def _change(self, name: str, rows: DataFrame, keys: list[str], gone: bool) -> None:
        numbers = self._numbers(name)
        if not numbers:
            self.write(name, self.read(name))
            numbers = self._numbers(name)
        value = self._list(name, numbers[-1])
        if value["changes"] and (value["keys"] != keys or len(value["changes"]) >= MOST_CHANGES):
            self.write(name, self.read(name))
            numbers = self._numbers(name)
            value = self._list(name, numbers[-1])
        self._put_list(name, numbers, {"rows": value["rows"], "keys": keys, "changes": [*value["changes"], {"rows": self._saved(name, rows), "gone": gone}]})

    def create(self, names: Iterable[str] = SCHEMAS) -> None:
        """Make the known tables that aren't there."""
        for name in names:
            if not self.exists(name):
                self.write(name, self.read(name))


class _SqlStore(Store):
    """Tables of a server. Rows go to a staging table first and from there into their table, in one transaction.

    Subclasses read, tell whether a table is there, make one like some rows, add rows, and run statements together.
    """

    INSERT = "INSERT INTO {t} ({c}) SELECT {c} FROM {s}"

    def _quoted(self, column: str) -> str:
        return f'"{column}"'

    def _made(self, name: str, rows: DataFrame) -> None:
        raise NotImplementedError

    def _added(self, name: str, rows: DataFrame) -> None:
        raise NotImplementedError

    def _run(self, *statements: str) -> None:
        raise NotImplementedError

    def read(self, name: str) -> DataFrame:
        return self._table(name) if self.exists(name) else self.spark.createDataFrame([], SCHEMAS[name][0])

    def _table(self, name: str) -> DataFrame:
        raise NotImplementedError

    def _staged(self, name: str, rows: DataFrame, *statements: str) -> None:
        """The statements, in which {s} is a staging table with rows and {c} its columns."""
        stage = f"{name}_stage_{uuid.uuid4().hex[:12]}"
        self._made(stage, rows)
        try:
            self._added(stage, rows)
            if not self.exists(name):
                self._made(name, rows)
            columns = ", ".join(map(self._quoted, rows.columns))
            self._run(*[x.format(t=name, s=stage, c=columns) for x in statements])
        finally:
            self._run(f"DROP TABLE {stage}")

    def _same(self, keys: list[str]) -> str:
        both = " AND ".join(f"{{s}}.{self._quoted(k)} = {{t}}.{self._quoted(k)}" for k in keys)
        return f"DELETE FROM {{t}} WHERE EXISTS (SELECT 1 FROM {{s}} WHERE {both})"

    def write(self, name: str, rows: DataFrame) -> None:
        self._staged(name, rows, "DELETE FROM {t}", self.INSERT)

    def upsert(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        self._staged(name, rows, self._same(keys), self.INSERT)

    def delete(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        if self.exists(name):
            self._staged(name, rows.select(*keys).distinct(), self._same(keys))


class JdbcStore(_SqlStore):
    """Tables of a JDBC URL."""

    def _options(self, name: str) -> dict[str, str]:
        return {"url": self.root, "dbtable": name} | ({"password": self.token} if self.token else {})

    def _jdbc(self, name: str) -> tuple[Any, Any]:
        """Spark's own connection to the URL, with the driver that it found, and the options."""
        jvm = self.spark.sparkContext._jvm
        jdbc = jvm.org.apache.spark.sql.execution.datasources.jdbc
        options = jdbc.JdbcOptionsInWrite(jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(self._options(name)))
        return jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.root).createConnectionFactory(options).apply(-1), options

    def _quoted(self, column: str) -> str:
        return self.spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.root).quoteIdentifier(column)

    def exists(self, name: str) -> bool:
        connection, options = self._jdbc(name)
        try:
            return self.spark.sparkContext._jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.tableExists(connection, options)
        finally:
            connection.close()

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self._options(name)).load()

    def _made(self, name: str, rows: DataFrame) -> None:
        self._added(name, self.spark.createDataFrame([], rows.schema))

    def _added(self, name: str, rows: DataFrame) -> None:
        rows.write.format("jdbc").options(**self._options(name)).mode("append").save()

    def _run(self, *statements: str) -> None:
        connection, _ = self._jdbc("none")
        try:
            connection.setAutoCommit(False)
            for x in statements:
                statement = connection.createStatement()
                statement.executeUpdate(x)
                statement.close()
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()


class HttpStore(_SqlStore):
    """Tables of an HTTP SQL server. Pages of rows are read and added by the executors, with positional parameters."""

    PAGE = 500
    #: A task that runs again adds its rows to the staging table again.
    INSERT = "INSERT INTO {t} ({c}) SELECT DISTINCT {c} FROM {s}"
    KINDS = {"INTEGER": "long", "INT": "long", "BIGINT": "long", "REAL": "double", "BLOB": "binary"}

    def __init__(self, spark: SparkSession, root: str, token: str = ""):
        super().__init__(spark, root, token)
        self.client = HttpSql(self.root, token)

    def exists(self, name: str) -> bool:
        return bool(self.client.scalar(self.client.execute("SELECT count(*) FROM sqlite_master WHERE type = 'table' AND name = ?", [name])))

    def _table(self, name: str) -> DataFrame:
        client, page = self.client, self.PAGE
        columns = client.rows(client.execute("SELECT name, type FROM pragma_table_info(?)", [name]))
        kind = ", ".join(f"`{c}` {self.KINDS.get(t.upper(), 'string')}" for c, t in columns)
        low, high = client.rows(client.execute(f"SELECT min(rowid), max(rowid) FROM {name}"))[0]
        names = ", ".join(self._quoted(c) for c, _ in columns)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in batch["id"]:
                    found = client.rows(client.execute(f"SELECT {names} FROM {name} WHERE rowid >= ? AND rowid < ?", [int(start), int(start) + page]))
                    yield pd.DataFrame(found, columns=[c for c, _ in columns], dtype=object)

        return self.spark.range(low or 0, (high or 0) + 1 if low is not None else 0, page).mapInPandas(run, kind)

    def _made(self, name: str, rows: DataFrame) -> None:
        kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "binary": "BLOB"}
        self.client.execute(f"CREATE TABLE {name} ({', '.join(f'{self._quoted(c)} {kinds.get(t, "TEXT")}' for c, t in rows.dtypes)})")

    def _added(self, name: str, rows: DataFrame) -> None:
        client, page = self.client, self.PAGE
        sql = f"INSERT INTO {name} ({', '.join(map(self._quoted, rows.columns))}) VALUES ({', '.join('?' * len(rows.columns))})"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(0, len(batch), page):
                    part = batch.slice(k, page)
                    client.together([(sql, list(r.values())) for r in part.to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array([len(batch)])], ["n"])

        rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()

    def _run(self, *statements: str) -> None:
        self.client.together([(x, []) for x in statements])


def read_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON document, or JSON documents, with a given schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_document(path: str, value: Any) -> None:
    """A JSON document, written as it reads."""
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


class HttpSql:
    """A client for SQL over HTTP: statements are posted together and their results come back in order."""

    def __init__(self, url: str, token: str, timeout: float = 30):
        self.url, self.token, self.timeout = url.strip().strip("\"'").replace("libsql://", "https://").rstrip("/"), token.strip().strip("\"'"), timeout

    @staticmethod
    def _argument(x: Any) -> dict[str, Any]:
        if x is None:
            return {"type": "null"}
        if isinstance(x, bytes | bytearray):
            return {"type": "blob", "base64": base64.b64encode(x).decode()}
        if isinstance(x, int):
            return {"type": "integer", "value": str(int(x))}
        return {"type": "float", "value": x} if isinstance(x, float) else {"type": "text", "value": str(x)}

    @staticmethod
    def _value(cell: dict[str, Any]) -> Any:
        kind = cell.get("type")
        if kind == "blob":
            return base64.b64decode(cell["base64"] + "=" * (-len(cell["base64"]) % 4))
        return int(cell["value"]) if kind == "integer" else None if kind == "null" else cell.get("value")

    def statement(self, sql: str, args: Iterable[Any] = ()) -> dict[str, Any]:
        """A statement and its positional parameters."""
        given = [self._argument(x) for x in args]
        return {"sql": sql} | ({"args": given} if given else {})

    def _post(self, wanted: dict[str, Any]) -> dict[str, Any]:
        body = json.dumps({"requests": [wanted, {"type": "close"}]}).encode()
        request = urllib.request.Request(f"{self.url}/v2/pipeline", body, {"Authorization": f"Bearer {self.token}", "Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return self.result(json.loads(answer.read()))

    def execute(self, sql: str, args: Iterable[Any] = ()) -> dict[str, Any]:
        return self._post({"type": "execute", "stmt": self.statement(sql, args)})

    def together(self, statements: list[tuple[str, list[Any]]]) -> None:
        """The statements in one transaction: each runs if the one before did, and the last one commits or else rolls back."""
        steps = [{"stmt": self.statement(sql, args)} for sql, args in [("BEGIN", []), *statements, ("COMMIT", [])]]
        for k, step in enumerate(steps[1:]):
            step["condition"] = {"type": "ok", "step": k}
        steps.append({"stmt": self.statement("ROLLBACK"), "condition": {"type": "not", "cond": {"type": "ok", "step": len(steps) - 1}}})
        failed = [x for x in self._post({"type": "batch", "batch": {"steps": steps}})["step_errors"][:-1] if x]
        if failed:
            raise RuntimeError(failed[0].get("message", "a statement failed"))

    @staticmethod
    def result(answer: dict[str, Any]) -> dict[str, Any]:
        answer = answer["results"][0]
        if answer.get("type") == "error":
            raise RuntimeError(answer["error"].get("message", "the statement failed"))
        return answer["response"]["result"]

    def rows(self, result: dict[str, Any]) -> list[list[Any]]:
        return [[self._value(c) for c in row] for row in result.get("rows", [])]

    def scalar(self, result: dict[str, Any]) -> Any:
        """The first cell of the first row; None without rows."""
        found = self.rows(result)
        return found[0][0] if found else None
