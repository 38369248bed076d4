"""Training-data operators over document tables.

One module per operator; ``queries.py`` wires each over the driver tables and
``oracle.py`` holds the SQL for those that SQL can express. Nothing outside
this subpackage (and ``corpus_pipeline.py``) imports it.
"""
