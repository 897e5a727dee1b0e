"""Spark event logs as (run_label, file, seq, block, ord, line) rows.

``read_event_logs`` reads any number of JSON-lines event logs in one scan
(``spark.read.text`` over a glob); each line keeps its run label (file name
without ``.json``, or the parent folder for rolling logs) and its place:
the file's number within a rolling log (``seq``, of ``events_<n>_...`` or
``part-<n>-...``; 0 otherwise), where its split or its group of frames begins in the file
(``block``) and an ordinal that grows within that (``ord``). The three are
fixed-width longs that order the lines of a log, plain or compressed, over any
number of files and tasks.

``events_as_listener_lines`` turns the supplied ``events`` table into
listener-event lines, one run per user, so the run-log job can be exercised
on data that grows with the test tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtally.session import listed_in_few_tasks

# Suffixes of zstd-compressed logs.
ZSTD_SUFFIXES = (".zstd", ".zst")
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
#: lines are handed on in batches of about this many bytes
BATCH_BYTES = 8 << 20
#: a task decodes groups of frames of about this many compressed bytes
GROUP_BYTES = 4 << 20
#: opening a log takes about as long as parsing this many bytes of it
OPEN_BYTES = 128 << 10


def _labels(path: Column, label: str | None, label_from: str) -> tuple[Column, Column]:
    name = F.element_at(F.split(path, "/"), -1)
    if label is not None:
        run = F.lit(label)
    elif label_from == "folder":
        run = F.element_at(F.split(path, "/"), -2)
    else:
        run = F.regexp_replace(name, r"\.json", "")
    # null where there is none: to try the cast of an empty text costs an exception, for every line
    digits = lambda pattern: F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("bigint")
    rolled = digits(r"^events_(\d+)_")
    part = digits(r"^part-(\d+)-") + 1  # as Spark names the files it writes
    seq = F.coalesce(rolled, part, F.lit(0).cast("bigint"))
    return run, seq


def _plain_path(uri: Column) -> Column:
    """The path of a file URI with its escapes decoded; ``+`` stands for itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def read_event_logs(spark: SparkSession, paths: str | list[str],
                    label: str | None = None, label_from: str = "file", recursive: bool = False) -> DataFrame:
    """(run_label, file, seq, block, ord, line) for every line of the given log files.

    ``label``: one fixed run label for everything read; otherwise the label
    is the file name with ``.json`` removed (``label_from="file"``) or the
    parent folder name (``label_from="folder"``, for rolling logs). ``file``
    is the log the line comes from: its folder for rolling logs, else its path.

    Files ending in ``.zstd`` or ``.zst`` are decoded as zstd, all others read
    as text (gzip and bzip2 by the text reader), file by file: a folder may
    hold both.

    ``recursive``: read the files at any depth below the paths. One folder that
    holds very many logs is listed far faster so than by a glob, of which the
    driver looks at every match several times.
    """
    path_list = [paths] if isinstance(paths, str) else list(paths)
    uri = F.col("_metadata.file_path")
    with listed_in_few_tasks(spark):
        plain = _read_text(spark, path_list, recursive)
        # a scan of the zstd files has no partition if there are none; nothing is read for this
        zstd = plain.filter(_is_zstd(uri)).rdd.getNumPartitions() > 0
        packed = _zstd_lines(spark, path_list, recursive) if zstd else None
    # A split's rows are scanned in order, so the generated id grows within it;
    # the splits of a file are ordered by where they begin.
    plain = plain.filter(~_is_zstd(uri)).select(
        _plain_path(uri).alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line"))
    lines = plain.unionByName(packed) if zstd else plain
    run, seq = _labels(F.col("path"), label, label_from)
    lines = lines.withColumn("seq", seq)
    file = F.when(F.col("seq") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.col("path"))
    return lines.select(run.alias("run_label"), file.alias("file"), "seq", "block", "ord", "line")


def _read_text(spark: SparkSession, paths: list[str], recursive: bool) -> DataFrame:
    """``spark.read.text`` whose tasks read as many short files as their bytes allow.

    Spark counts the opening of a file as 4 MB, so that a task reads 32 logs
    however short they are. The scan takes that figure from the session that
    made it, when it runs: here from a copy of this one.
    """
    session = spark._jsparkSession.cloneSession()
    session.conf().set("spark.sql.files.openCostInBytes", str(OPEN_BYTES))
    reader = session.read().option("recursiveFileLookup", recursive)
    scan = reader.text(spark._jvm.PythonUtils.toSeq(paths)).queryExecution().analyzed()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, scan), spark)


def _is_zstd(path: Column) -> Column:
    return path.endswith(ZSTD_SUFFIXES[0]) | path.endswith(ZSTD_SUFFIXES[1])


def _zstd_lines(spark: SparkSession, paths: list[str], recursive: bool) -> DataFrame:
    """(path, block, ord, line) of the zstd files under ``paths``.

    A file is read once, as it is and as a stream: one row per piece between
    two frame magics. Its frames are put together in groups that end where a
    line ends; the groups (compressed bytes) are dealt over tasks and decoded
    there. So neither a file nor its text is ever one row, and one large log is
    decoded by many tasks. (A log of a single frame is one group.)
    """
    groups = None
    for suffix in ZSTD_SUFFIXES:
        reader = spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", recursive)
        # the magic as line separator; the suffix read as it is, not decompressed
        reader = reader.option("encoding", "ISO-8859-1").option("lineSep", ZSTD_MAGIC.decode("latin-1"))
        reader = reader.option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
        for key in ("io.compress.passthrough.extension", "org.apache.hadoop.shaded.io.compress.passthrough.extension"):
            reader = reader.option(key, suffix)
        raw = reader.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))
        found = raw.mapInArrow(_grouper(GROUP_BYTES), "path string, block long, before binary, frames binary, cut boolean")
        groups = found if groups is None else groups.unionByName(found)
    groups = groups.repartition("path", "block").withColumn("path", _plain_path(F.col("path")))
    return groups.mapInArrow(_decoder(BATCH_BYTES), "path string, block long, ord long, line string")


def _grouper(group_bytes: int):
    """Pieces between magics -> groups of whole frames.

    ``before``: the start of a group's first line, where the frame before it
    ends within a line; that frame's group leaves it out (``cut``).
    """
    # Built inside a function, so that Spark ships its code and workers need
    # no copy of this package.
    magic = ZSTD_MAGIC

    def frame_end(data, at):
        """Where the frame at ``at`` ends (RFC 8878, 3.1); None if it is not all there."""
        if data[at:at + 4] != magic:
            if len(data) - at >= 8 and data[at + 1:at + 4] == b"\x2a\x4d\x18" and 0x50 <= data[at] <= 0x5F:
                end = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")  # skippable
                return end if end <= len(data) else None
            raise ValueError("not a zstd frame")
        if len(data) < at + 5:
            return None
        kind = data[at + 4]
        single = kind >> 5 & 1
        end = at + 5 + (not single) + (0, 1, 2, 4)[kind & 3] + (single, 2, 4, 8)[kind >> 6]
        while True:
            if end + 3 > len(data):
                return None
            block = int.from_bytes(data[end:end + 3], "little")
            end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            if block & 1:
                end += 4 * (kind >> 2 & 1)
                return end if end <= len(data) else None

    def group(batches):
        import pyarrow as pa
        import zstandard

        path, block, before, frames, waiting = None, 0, b"", [], b""

        def row(cut):
            nonlocal block, frames
            made = (path, block, before, b"".join(frames), cut)
            block, frames = block + 1, []
            return made

        def table(rows):
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                              names=["path", "block", "before", "frames", "cut"])

        for batch in batches:
            for here, piece in zip(batch.column(0), batch.column(1)):
                here, piece, first = here.as_py(), piece.as_py(), False
                if here != path:
                    if waiting:
                        frames.append(waiting)  # a log still being written
                    if frames or before:
                        yield table([row(False)])
                    path, block, before, frames, waiting, first = here, 0, b"", [], b"", True
                # a magic may also occur inside a frame, which then goes on
                waiting += piece if first else magic + piece
                at = 0
                while at < len(waiting):
                    end = frame_end(waiting, at)
                    if end is None:
                        break
                    frames.append(waiting[at:end])
                    at = end
                waiting = waiting[at:]
                if at and not waiting and sum(map(len, frames)) >= group_bytes:
                    text = zstandard.ZstdDecompressor().decompressobj().decompress(frames[-1])
                    start = text.rfind(b"\n") + 1
                    if start:
                        yield table([row(start < len(text))])
                        before = text[start:]
        if waiting:
            frames.append(waiting)
        if frames or before:
            yield table([row(False)])

    return group


def _decoder(batch_bytes: int):
    """Groups of frames -> lines, in batches."""
    def decode(batches):
        import io

        import pyarrow as pa
        import zstandard

        def table(path, block, first, lines):
            n = len(lines)
            return pa.RecordBatch.from_arrays(
                [pa.array([path] * n, pa.string()), pa.array([block] * n, pa.int64()),
                 pa.array(range(first, first + n), pa.int64()), pa.array(lines, pa.string())],
                names=["path", "block", "ord", "line"])

        for batch in batches:
            for path, block, before, frames, cut in zip(*(batch.column(i) for i in range(5))):
                path, block, cut, start = path.as_py(), block.as_py(), cut.as_py(), before.as_py()
                raw = zstandard.ZstdDecompressor().stream_reader(pa.BufferReader(frames.as_buffer()), read_across_frames=True)
                first, lines, size, whole = 0, [], 0, True
                for line in io.BufferedReader(raw, 1 << 17):
                    line, start, whole = start + line, b"", line.endswith(b"\n")
                    if not whole and cut:
                        break  # the next group has it
                    lines.append((line[:-1] if whole else line).decode("utf-8", "replace"))
                    size += len(line)
                    if size >= batch_bytes:
                        yield table(path, block, first, lines)
                        first, lines, size = first + len(lines), [], 0
                if start:
                    lines.append(start.decode("utf-8", "replace"))
                if lines:
                    yield table(path, block, first, lines)

    return decode


def write_rolling_logs(lines: DataFrame, path: str, rows_per_file: int = 1_000_000, least: int = 1, rows: int | None = None) -> None:
    """Write lines (run_label, ord, line) as one log folder ``run_label=<run>`` per run, in rolling files.

    Lines are dealt by ranges of (run, ord), so a run with a third of all lines
    is sorted and written by many tasks, a file each; the files' numbers grow
    with ``ord``. There are as many ranges as make about ``rows_per_file`` lines
    each, and no fewer than ``least``. ``rows``: how many lines there are, where
    that is known without building them; it says nothing of which are written.

    In a folder of the ``file`` scheme the tasks write the files themselves:
    without its native library, Hadoop starts a process (chmod) three times per
    file that it creates there, far longer than writing a short log takes.
    """
    keys = ["run_label", "ord"]
    ranges = max(least, -(-(lines.count() if rows is None else rows) // rows_per_file))
    dealt = lines.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    folder = _emptied_local_folder(lines.sparkSession, path)
    if folder is None:
        dealt.select("run_label", "line").write.mode("overwrite").partitionBy("run_label").text(path)
    else:
        names = lines.sparkSession._jvm.System.getProperty("sun.jnu.encoding")  # of file names, as the reader has it
        written = dealt.select("run_label", F.col("line").cast("binary").alias("line"))
        written.mapInArrow(_run_writer(folder, uuid.uuid4().hex, names), "files long").agg(F.sum("files")).collect()


def _emptied_local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder as tasks open it, new and empty, if its scheme is ``file``; else None."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.getUri().getScheme() != "file":
        return None
    fs.delete(at, True)
    if not fs.mkdirs(at):
        raise OSError(f"cannot make the folder {path}")
    return fs.makeQualified(at).toUri().getPath()


def _run_writer(folder: str, job: str, encoding: str):
    """Rows (run_label, line), sorted by run -> a file per run in its folder, named as Spark names it.

    A file is written under a hidden name and renamed once it is whole; a task
    that is tried again puts the same file in place of the first.
    """
    # as partition folders are named: escaped, and one name for what is null or empty
    escaped = {c: f"%{c:02X}" for c in (*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^"))}

    def write(batches):
        import os

        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{job}.c000.txt"
        run, out, files = None, None, 0

        def finish():
            out.close()
            os.replace(out.name, os.path.join(run, name.encode()))

        for batch in batches:
            lines, begin = batch.column(1).to_pylist(), 0
            runs = pc.run_end_encode(batch.column(0))
            for label, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                label = label.translate(escaped) if label else "__HIVE_DEFAULT_PARTITION__"
                here = f"{folder}/run_label={label}".encode(encoding, "replace")
                if here != run:
                    if out:
                        finish()
                    os.makedirs(here, exist_ok=True)
                    run, out, files = here, open(os.path.join(here, f".{name}.{task.taskAttemptId()}".encode()), "wb"), files + 1
                out.write(b"".join((line or b"") + b"\n" for line in lines[begin:end]))
                begin = end
        if out:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    return write


def _ms(ts_col: str = "ts"):
    """Epoch milliseconds of a timestamp without time zone (session-TZ free)."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts_col})")


def events_as_listener_lines(events: DataFrame) -> DataFrame:
    """Map ``events`` rows onto listener-event JSON lines (one run per user).

    signup -> ApplicationStart, or ExecutorAdded (executor k modulo 7) when k
    is a multiple of 3; purchase -> ApplicationEnd; view -> StageSubmitted
    (stage k, k tasks); error -> StageCompleted (failed when k is odd), click
    -> TaskEnd (failed when k is a multiple of 5; run time = value seconds; no
    metrics when k is 7 modulo 10), where k is the ``props`` field ``k``.

    Of the errors with k a multiple of 10 the lines are not what a log holds:
    by k / 10 modulo 5 a stray brace, two objects, trailing text, single
    quotes, or a blank line. The first four are no valid JSON.
    """
    events = events.select("user_id", "event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                           _ms().alias("ms"), F.round(F.col("value") * 1000).cast("bigint").alias("run_ms"))
    k, ts, run_ms = F.col("k"), F.col("ms"), F.col("run_ms")
    start = F.to_json(F.struct(F.lit("SparkListenerApplicationStart").alias("Event"),
                               ts.alias("Timestamp")))
    end = F.to_json(F.struct(F.lit("SparkListenerApplicationEnd").alias("Event"),
                             ts.alias("Timestamp")))
    submitted = F.to_json(F.struct(
        F.lit("SparkListenerStageSubmitted").alias("Event"),
        F.struct(k.alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"),
                 F.concat(F.lit("stage "), k.cast("string")).alias("Stage Name"),
                 k.alias("Number of Tasks"), ts.alias("Submission Time")).alias("Stage Info")))
    completed = F.to_json(F.struct(
        F.lit("SparkListenerStageCompleted").alias("Event"),
        F.struct(k.alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"),
                 ts.alias("Completion Time"),
                 F.when(k % 2 == 1, F.concat(F.lit("failed "), k.cast("string")))
                 .otherwise(F.lit("")).alias("Failure Reason")).alias("Stage Info")))
    kind = (k / 10).cast("bigint") % 5
    odd = (F.when(kind == 0, F.concat(F.lit("{"), completed))
           .when(kind == 1, F.concat(completed, completed))
           .when(kind == 2, F.concat(completed, F.lit(" trailing")))
           .when(kind == 3, F.translate(completed, '"', "'"))
           .otherwise(F.lit("  ")))
    executor = F.to_json(F.struct(F.lit("SparkListenerExecutorAdded").alias("Event"),
                                  (k % 7).cast("string").alias("Executor ID")))
    task = F.to_json(F.struct(
        F.lit("SparkListenerTaskEnd").alias("Event"),
        F.struct(F.when(k % 5 == 0, F.lit("ExceptionFailure")).otherwise(F.lit("Success"))
                 .alias("Reason")).alias("Task End Reason"),
        F.struct(ts.alias("Launch Time"), (ts + run_ms).alias("Finish Time")).alias("Task Info"),
        F.when(k % 10 != 7, F.struct(
                 run_ms.alias("Executor Run Time"), k.alias("JVM GC Time"),
                 F.struct((k * 1000).alias("Remote Bytes Read"),
                          (k * 24).alias("Local Bytes Read")).alias("Shuffle Read Metrics"),
                 F.struct((k * 4096).alias("Shuffle Bytes Written")).alias("Shuffle Write Metrics"),
                 F.struct(F.floor(F.col("value") * 1048576).alias("Bytes Read"))
                 .alias("Input Metrics"))).alias("Task Metrics")))
    et = F.col("event_type")
    line = (F.when(et == "signup", F.when(k % 3 == 0, executor).otherwise(start)).when(et == "purchase", end)
            .when(et == "view", submitted)
            .when(et == "error", F.when(k % 10 == 0, odd).otherwise(completed))
            .when(et == "click", task)
            .otherwise(F.lit("")))
    # generated, so that what reads the line several times does not build it several times
    built = events.select("user_id", "event_id", F.explode(F.array(line)).alias("line"))
    return built.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("run_label"),
                         F.lit("events").alias("file"), F.lit(0).cast("bigint").alias("seq"),
                         F.lit(0).cast("bigint").alias("block"), F.col("event_id").alias("ord"), "line")
