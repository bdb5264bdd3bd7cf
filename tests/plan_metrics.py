"""Row counts of an executed plan, read from its metrics."""


def nodes(df):
    """All nodes of the executed (final adaptive) plan of a DataFrame that has been run through its own query execution."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        out.append(node)
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def metric(node, name):
    m = node.metrics().get(name)
    return m.get().value() if m.isDefined() else 0


def shuffled_rows(df):
    """Rows that each shuffle of the plan has written."""
    df.collect()
    return sorted(metric(n, "shuffleRecordsWritten") for n in nodes(df) if n.getClass().getSimpleName() == "ShuffleExchangeExec")


def scanned_rows(df):
    """Rows that the file scans of the plan have returned."""
    df.collect()
    return sum(metric(n, "numOutputRows") for n in nodes(df) if n.getClass().getSimpleName() == "FileSourceScanExec")
