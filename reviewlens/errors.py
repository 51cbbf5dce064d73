"""Which errors mean that a dataset cannot be read or written."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

#: A missing or foreign path, or a corrupt file, whether met while planning or while running.
UNREADABLE = (PySparkException, Py4JJavaError)


def brief(error: Exception) -> str:
    """The first line of an error's text, with the cause that the JVM names."""
    if isinstance(error, Py4JJavaError):
        return str(error.java_exception).splitlines()[0]
    return (str(error).splitlines() or [type(error).__name__])[0]
