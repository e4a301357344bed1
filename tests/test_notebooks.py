"""Notebook scan and the content test over nested cells."""
import json
import os

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from lodestone.functions.predicates import cells_contain_grouped, notebook_contains
from lodestone.session import read_table
from lodestone.sources.files import notebook_scan


def _write(tmp, name, content):
    with open(os.path.join(tmp, name), "w") as fh:
        fh.write(content)


def test_cases(spark, tmp):
    nb = lambda cells: json.dumps({"cells": cells, "nbformat": 4})
    _write(tmp, "import.ipynb", nb([{"cell_type": "code", "source": "import pandas as pd"}]))
    _write(tmp, "pd.ipynb", nb([{"cell_type": "code", "source": ["x = 1\n", "pd.read_csv('f')"]}]))
    _write(tmp, "markdown.ipynb", nb([{"cell_type": "markdown", "source": "import pandas"}]))
    _write(tmp, "upper.ipynb", nb([{"cell_type": "code", "source": "import Pandas; PD.x"}]))
    _write(tmp, "empty.ipynb", nb([]))
    _write(tmp, "broken.ipynb", "{not json")
    _write(tmp, "array.ipynb", json.dumps([{"cells": []}, {"cells": [{"cell_type": "code", "source": "pd.x"}]}]))
    _write(tmp, "old.ipynb", json.dumps({"worksheets": [{"cells": [{"cell_type": "markdown", "input": "pd."}]},
                                                        {"cells": [{"cell_type": "code", "input": ["import pandas\n"]}]}, {}]}))
    _write(tmp, "blank.ipynb", "")
    _write(tmp, "lead.ipynb", "\n  " + nb([{"cell_type": "code", "source": "pd.x"}]))
    df = notebook_contains(notebook_scan(spark, tmp))
    got = {os.path.basename(r.path): r.contains for r in df.collect()}
    assert got == {"import.ipynb": True, "pd.ipynb": True, "markdown.ipynb": False,
                   "upper.ipynb": False, "empty.ipynb": False, "broken.ipynb": False,
                   "array.ipynb": False, "old.ipynb": True, "lead.ipynb": True, **({"blank.ipynb": False} if "blank.ipynb" in got else {})}
    # a second scan sees the same schema (the module schema is not mutated)
    assert notebook_scan(spark, tmp).columns == ["path", "cells"]
    from lodestone.sources.files import NOTEBOOK_SCHEMA
    assert NOTEBOOK_SCHEMA.fieldNames() == ["cells", "worksheets"]


def test_nested_equals_grouped_on_conversations(spark):
    conv = read_table(spark, SF_SMALL, "conversations")
    terms = ("tion", "pd.")
    nested = (conv.groupBy("conv_id")
              .agg(F.collect_list(F.struct(F.col("role").alias("cell_type"), F.col("text").alias("source")))
                   .alias("cells")))
    a = {r.conv_id: r.contains for r in notebook_contains(nested, terms, "user").collect()}
    b = {r.conv_id: r.contains for r in cells_contain_grouped(conv, "conv_id", "role", "text", terms, "user").collect()}
    assert a == b and any(a.values()) and not all(a.values())


def test_many_folders_are_listed_by_few_tasks(spark, tmp):
    """A folder per notebook: the listing has a few tasks per core, not one per
    folder, finds all of them and leaves the session's setting as it was."""
    import lodestone.sources.files as files
    n = 8 * spark.sparkContext.defaultParallelism + 30
    for i in range(n):
        os.mkdir(os.path.join(tmp, f"k={i}"))
        _write(os.path.join(tmp, f"k={i}"), "a.txt", json.dumps({"cells": [{"cell_type": "code", "source": "pd." if i % 2 else ""}]}))
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.sparkContext.setJobGroup("listing", "listing")
    books = files.notebook_scan(spark, f"{tmp}/*")
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(tasks) == 8 * spark.sparkContext.defaultParallelism < n
    assert spark.conf.get(name) == before
    assert sorted(r.contains for r in notebook_contains(books).collect()) == sorted(i % 2 == 1 for i in range(n))
