"""Table-level operators: DataFrame in, DataFrame or model-sized result out."""
