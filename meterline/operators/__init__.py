"""DataFrame-in, DataFrame-out steps of the warehouse and the fare model."""
