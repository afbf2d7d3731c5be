"""The models, gates, reports and KPIs as logical plans over DataFrames."""
