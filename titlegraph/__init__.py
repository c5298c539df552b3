"""titlegraph: record linkage and text annotation for title and person data on Spark."""
