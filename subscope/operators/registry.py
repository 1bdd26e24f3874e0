"""Stored models, found again by what they were trained on.

A model lies below a root folder under a key: the digest of its training rows, its settings and Spark's version. It is
written to a folder of its own, and then a small marker file, which appears whole by a rename, says which folder counts.
So a half-written model is never read, and of two sessions that train the same model at once one wins.
"""

import hashlib
import json
import uuid

import pyspark
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKER = "current"


def _steady(field, digits):
    column = F.col(field.name)
    if isinstance(field.dataType, VectorUDT):
        return F.transform(vector_to_array(column), lambda x: F.round(x, digits))
    return F.round(column, digits) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else column


def rows_digest(df, digits=6):
    """A digest of all rows that does not depend on their order or partitioning.

    Doubles count to `digits` places, since their last ones depend on the order of summation.
    """
    columns = [_steady(field, digits) for field in sorted(df.schema.fields, key=lambda field: field.name)]
    hashed = df.select(F.xxhash64(*columns).alias("h"), F.xxhash64(F.lit("second"), *columns).alias("g"))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string") for c in ("h", "g")]
    found = hashed.agg(F.count("*").alias("n"), *[s.alias(c) for s, c in zip(sums, "hg")]).first()
    return f"{found['n']} {found['h']} {found['g']} {df.select(sorted(df.columns)).schema.simpleString()}"


def model_key(kind, train, **settings):
    """The folder name of a model: what kind, and a digest of all that decides its outcome."""
    text = json.dumps([kind, rows_digest(train), settings, pyspark.__version__], sort_keys=True, default=str)
    return f"{kind}-{hashlib.sha256(text.encode()).hexdigest()[:32]}"


def _file_system(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark, text):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def find_model(spark, root, key):
    """The folder of a stored model, or None."""
    marker = f"{root}/{key}/{MARKER}"
    if not _file_system(spark, root).exists(_path(spark, marker)):
        return None
    return f"{root}/{key}/{spark.read.text(marker).first()[0]}"


def store_model(spark, root, key, write):
    """Call `write(folder)` and make that folder the model of the key, unless another one has become it meanwhile."""
    folder = uuid.uuid4().hex
    write(f"{root}/{key}/{folder}")
    files, note = _file_system(spark, root), _path(spark, f"{root}/{key}/{folder}.{MARKER}")
    stream = files.create(note, True)
    try:
        stream.write(bytearray(folder.encode()))
    finally:
        stream.close()
    files.rename(note, _path(spark, f"{root}/{key}/{MARKER}"))  # not done where the marker exists
    return find_model(spark, root, key)


def stored_model(spark, root, key, write):
    """The folder of the key's model; `write(folder)` fits and writes it if no session has done so yet."""
    return find_model(spark, root, key) or store_model(spark, root, key, write)
