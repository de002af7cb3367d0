"""Named compositions of the operators: the mart DAG and the report job."""
