"""Jobs: ``python -m fareloom.jobs.<name>`` or ``spark-submit``; every path is an argument."""
