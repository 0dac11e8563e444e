"""Tables that are replaced as a whole while they are read, by themselves too.

Each write goes to a new folder beside the versions before it; a small file names the one
that counts, and is put in place by one rename. A reader sees the old or the new version,
never a mixture, and a write that breaks off leaves the old one. A folder without that
file is its own first version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Names that scans of the folder itself pass over.
CURRENT, VERSIONS = "_current", "_versions"


def _files(spark: SparkSession, path: str):
    """Hadoop's Path class and the file context of ``path``."""
    fs = spark._jvm.org.apache.hadoop.fs
    place = fs.Path(path).toUri()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return fs, fs.Path(path).getFileSystem(conf), (
        fs.FileContext.getFileContext(place, conf) if place.getScheme() else fs.FileContext.getFileContext(conf))


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the version that counts now; ``path`` itself where nothing was replaced yet."""
    fs, system, _ = _files(spark, path)
    manifest = fs.Path(path, CURRENT)
    if not system.exists(manifest):
        return path
    stream = system.open(manifest)
    try:
        name = stream.readUTF()
    finally:
        stream.close()
    return f"{path}/{VERSIONS}/{name}"


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill the folder it is given, then make that the version of ``path``; returns the folder.

    ``write`` may read any version of ``path``. Of two writers at once the later rename counts. Older versions stay
    for those who still read them; whoever owns the table removes them.
    """
    name = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{VERSIONS}/{name}"
    write(folder)
    fs, system, context = _files(spark, path)
    staged = fs.Path(path, f"{CURRENT}-{name}")
    stream = system.create(staged, True)
    stream.writeUTF(name)
    stream.close()
    options = spark._jvm.java.lang.reflect.Array.newInstance(
        spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(fs, "Options$Rename").OVERWRITE
    context.rename(staged, fs.Path(path, CURRENT), options)
    return folder
