"""Where intermediate tables go."""

import tempfile
import uuid


def scratch_path(spark, name):
    """A new folder for one intermediate table, in the place that the whole cluster shares.

    That place is ``spark.checkpoint.dir``. A local session without it gets a temporary
    folder; a cluster without it is refused, since its executors would each write to a disk
    of their own. Folders stay until the job that reads them has ended, so they are left to
    whoever clears the shared place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("name a shared folder in spark.checkpoint.dir")
        shared = "file://" + tempfile.mkdtemp(prefix="widevec-")
    return f"{shared.rstrip('/')}/widevec-{uuid.uuid4().hex}/{name}"
