def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
