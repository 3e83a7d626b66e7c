"""Publishing to a relational mart over JDBC.

A publish is staged and applied: the rows are written in parallel to a staging table of their
own, then one statement in the database merges them by key (or replaces the table), in one
transaction with a note of the batch.  So readers see all of a batch or none of it, a job that
ends in between changes nothing, and a batch that is published again is left out - also when
later batches have overwritten its rows since.

The database must know MERGE (SQL:2003).  Rows go from the executors to the database; the
driver sends the statements only.  NULL keys match nothing and are inserted; two staged rows
that match one row of the table make the database refuse the batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

BATCHES = "published_batches"


class Mart:
    """Tables of one database.  `text_type` is the column type of strings (keys must compare)."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str],
                 text_type: str = "VARCHAR(4000)"):
        self.spark, self.url, self.text_type = spark, url, text_type
        self.properties = {k: str(v) for k, v in properties.items()}

    # --- the database's side -----------------------------------------------------

    def _connect(self):
        jvm = self.spark._jvm
        given = jvm.java.util.Properties()
        for key, value in self.properties.items():
            given.setProperty(key, value)
        if "driver" in self.properties:     # also one that came with the job's own jars
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            driver = jvm.java.lang.Class.forName(self.properties["driver"], True, loader).newInstance()
            connection = driver.connect(self.url, given)
        else:
            connection = jvm.java.sql.DriverManager.getConnection(self.url, given)
        connection.setAutoCommit(False)
        return connection

    @staticmethod
    def _execute(connection, sql: str, *values: str) -> int:
        statement = connection.prepareStatement(sql)
        try:
            for at, value in enumerate(values, 1):
                statement.setString(at, value)
            return statement.executeUpdate()
        finally:
            statement.close()

    @staticmethod
    def _found(connection, sql: str, *values: str) -> bool:
        statement = connection.prepareStatement(sql)
        try:
            for at, value in enumerate(values, 1):
                statement.setString(at, value)
            return bool(statement.executeQuery().next())
        finally:
            statement.close()

    @staticmethod
    def _exists(connection, table: str) -> bool:
        tables = connection.getMetaData().getTables(None, None, "%", None)
        while tables.next():
            if str(tables.getString("TABLE_NAME")).lower() == table.lower():
                return True
        return False

    def _transaction(self, work):
        connection = self._connect()
        try:
            done = work(connection)
            connection.commit()
            return done
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    # --- publishing ----------------------------------------------------------------

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        types = ", ".join(f"`{c}` {self.text_type}" for c, kind in df.dtypes if kind == "string")
        writer = df.write.mode(mode)
        if types:
            writer = writer.option("createTableColumnTypes", types)
        writer.jdbc(self.url, table, properties=self.properties)

    def table(self, table: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, table, properties=self.properties)

    def upsert(self, table: str, df: DataFrame, keys: list[str], batch: str) -> bool:
        """Merge `df` into `table` by its keys; False if `batch` was published before."""
        on = " AND ".join(f't."{c}" = s."{c}"' for c in keys)
        rest = ", ".join(f'"{c}" = s."{c}"' for c in df.columns if c not in keys)
        matched = f" WHEN MATCHED THEN UPDATE SET {rest}" if rest else ""
        columns = ", ".join(f'"{c}"' for c in df.columns)
        values = ", ".join(f's."{c}"' for c in df.columns)
        return self._publish(table, df, batch, lambda stage: [
            f"MERGE INTO {table} t USING {stage} s ON {on}{matched} "
            f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({values})"])

    def snapshot(self, table: str, df: DataFrame, batch: str) -> bool:
        """Replace all rows of `table` by `df`; False if `batch` was published before."""
        columns = ", ".join(f'"{c}"' for c in df.columns)
        return self._publish(table, df, batch, lambda stage: [
            f"DELETE FROM {table}", f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}"])

    def _publish(self, table: str, df: DataFrame, batch: str, statements) -> bool:
        note = (table.lower(), batch)
        known = f"SELECT 1 FROM {BATCHES} WHERE table_name = ? AND batch = ?"

        def prepare(connection) -> tuple[bool, bool]:
            if not self._exists(connection, BATCHES):
                self._execute(connection, f"CREATE TABLE {BATCHES} (table_name VARCHAR(200) NOT NULL, "
                                          "batch VARCHAR(200) NOT NULL, PRIMARY KEY (table_name, batch))")
            return self._found(connection, known, *note), self._exists(connection, table)

        published, exists = self._transaction(prepare)
        if published:
            return False
        if not exists:
            self._write(df.limit(0), table, "append")
        stage = f"{table}_{hashlib.sha256(batch.encode()).hexdigest()[:12]}"
        self._write(df, stage, "overwrite")

        def apply(connection) -> None:
            self._execute(connection, f"INSERT INTO {BATCHES} VALUES (?, ?)", *note)
            for sql in statements(stage):
                self._execute(connection, sql)

        self._transaction(apply)
        self._transaction(lambda connection: self._execute(connection, f"DROP TABLE {stage}"))
        return True
