"""DuckDB SQL twins of the registered queries.

Independent formulations (window functions, list functions, plain joins) over
the same driver tables; fixtures are CTEs that mirror FIXTURES.md. Each string
runs on DuckDB with the driver tables registered as views.
"""

from __future__ import annotations

STEM_RE = r"^(\.*[^.].*)\.[^.]*$"


def _stem(expr: str) -> str:
    return f"(case when regexp_matches({expr}, '{STEM_RE}') then regexp_extract({expr}, '{STEM_RE}', 1) else {expr} end)"


def _base(expr: str) -> str:
    return f"regexp_extract({expr}, '([^/]*)$', 1)"


def _f5(expr: str) -> str:
    return f"cast(cast(round(cast({expr} as decimal(38,12)), 5) as decimal(38,5)) as varchar)"


def _r6(expr: str) -> str:
    return f"(round(cast({expr} as double), 6) + 0.0)"


BOX = "struct(x1 float, y1 float, x2 float, y2 float, conf float, cls integer)"

# Fixture CTEs in dependency order.
FX: dict[str, str] = {
    "files_fx": """select doc_id, printf('/raw/%s/clip.%d.%s', source, doc_id,
        ['mp4','MOV','avi','txt','mkv'][doc_id % 5 + 1]) as path from documents""",
    "decoded_fx": """select printf('user_%d', user_id) as video_id,
        row_number() over (partition by user_id order by ts, event_id) - 1 as frame_number,
        date_diff('microsecond', min(ts) over (partition by user_id), ts) / 1000.0::double as pos_ms,
        1920 as width, 1080 as height from events""",
    "frames_fx": """select video_id, printf('%s__%06d', video_id, frame_number) as frame_id,
        printf('/frames/%s/%s__%06d.jpg', video_id, video_id, frame_number) as frame_path,
        trunc(pos_ms)::bigint as timestamp_ms, width, height
        from decoded_fx where frame_number % 30 = 0""",
    "scored_fx": "select frame_id from frames_fx where timestamp_ms % 3 = 0",
    "boxes_fx": """select l_orderkey as k, (l_linenumber)::float as x1, (l_quantity)::float as y1,
        (l_linenumber + 10)::float as x2, (l_quantity + 20)::float as y2,
        (l_discount * 10)::float as conf, (l_suppkey % 3)::int as cls
        from lineitem""",
    "detections_fx": """select printf('order_%d__%06d', o.o_orderkey, coalesce(b.f, 0)) as frame_id,
        printf('cust_%d', o_custkey) as video_id, o_orderdate as inferred_at, b.boxes
        from orders o
        left join (select k, f, list({'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'conf': conf, 'cls': cls}
                          order by conf desc, x1, y1, x2, y2, cls) as boxes
                   from (select *, (row_number() over (partition by k order by conf desc, x1, y1, x2, y2, cls) - 1) // 8 as f
                         from boxes_fx)
                   group by k, f) b on o.o_orderkey = b.k""",
    "metrics": """select frame_id, video_id, inferred_at, coalesce(len(boxes), 0)::int as n_detections,
        case when coalesce(len(boxes), 0) > 0
             then list_sum(list_transform(boxes, lambda b: b.conf::double)) / len(boxes)
             else 0.0::double end as avg_conf
        from detections_fx""",
    "runs_fx": """select printf('det_%d', o_custkey % 50) as name, o_orderkey as run_id,
        case when o_custkey % 50 = 47 then 'FAILED' when o_orderstatus = 'F' then 'FINISHED'
             when o_orderstatus = 'O' then 'RUNNING' else 'FAILED' end as status,
        o_orderdate as start_time,
        try_cast(case when o_orderkey % 7 = 0 or o_custkey % 50 = 48 then null when o_orderkey % 11 = 0 then 'n/a'
             else '0.' || lpad(((o_orderkey * 7919 + o_custkey) % 100000)::varchar, 5, '0') end as double) as map50,
        try_cast('0.' || lpad((o_custkey % 1000)::varchar, 3, '0') as double) as precision
        from orders""",
    "versions_fx": """select distinct printf('det_%d', o_custkey % 50) as name, l_orderkey as run_id,
        cast(l_orderkey * 10 + l_linenumber as varchar) as version
        from lineitem join orders on l_orderkey = o_orderkey where o_custkey % 50 <> 49""",
    "al_v": "select name, run_id, max(cast(version as bigint)) as version from versions_fx group by 1, 2",
    "al_r": """select r.name, r.run_id, r.map50, v.version, cast(substr(r.name, 5) as int) as m
        from runs_fx r join al_v v on r.name = v.name and r.run_id = v.run_id where status = 'FINISHED'""",
    "al_k": """select *, row_number() over (partition by name order by map50 desc nulls last, run_id) as rk,
        row_number() over (partition by name, map50 is null order by run_id) as nk from al_r""",
    "aliases_fx": """select name, 'champion' as alias, cast(version as varchar) as version from al_k
        where (m % 5 = 1 and map50 is null and nk = 1) or (m % 5 > 1 and rk = 2 + m % 7)""",
    # promotion decisions (shared by several queries)
    "pr_nv": "select name, run_id, max(version::bigint)::varchar as version from versions_fx group by 1, 2",
    "pr_fv": """select r.name, r.run_id, r.map50 as metric, nv.version from runs_fx r
        left join pr_nv nv on r.name = nv.name and r.run_id = nv.run_id where r.status = 'FINISHED'""",
    "pr_rk": """select *, row_number() over (partition by name order by metric desc nulls last, run_id) as rn
        from pr_fv""",
    "pr_best": """select name, count(*) as n_finished, max(case when rn = 1 then run_id end) as best_run_id,
        max(case when rn = 1 then metric end) as best_metric,
        max(case when rn = 1 then version end) as best_version from pr_rk group by name""",
    "pr_chall": """select rk.name, first(rk.version order by rk.rn) as challenger from pr_rk rk
        join pr_best b on rk.name = b.name
        where rk.version is not null and rk.version <> b.best_version group by rk.name""",
    "pr_champ": """select m.name, c.champion_version, vv.run_id as champion_run_id, r.map50 as champion_metric
        from (select distinct name from runs_fx) m
        left join (select name, version as champion_version from aliases_fx where alias = 'champion') c
               on m.name = c.name
        left join (select distinct name, version, run_id from versions_fx) vv
               on vv.name = m.name and vv.version = c.champion_version
        left join runs_fx r on r.name = m.name and r.run_id = vv.run_id""",
    "pr_j": """select m.name, b.n_finished, b.best_run_id, b.best_metric, b.best_version,
        c.champion_version, c.champion_metric, ch.challenger,
        case when b.n_finished is null then 'error_no_runs' when b.best_metric is null then 'error_no_metric'
             when b.best_version is null then 'error_no_version' else 'ok' end as status
        from (select distinct name from runs_fx) m
        left join pr_best b on m.name = b.name left join pr_champ c on m.name = c.name
        left join pr_chall ch on m.name = ch.name""",
    "decisions": """select *,
        status = 'ok' and (champion_metric is null or best_metric > champion_metric * 1.02::double) as promote,
        case when status = 'ok' then challenger end as challenger_version
        from pr_j""",
    # the same, with candidates from an experiment
    "ex_scope": """select distinct name, printf('exp_%d', cast(substr(name, 5) as int) * 7 % 12) as experiment from runs_fx""",
    "ex_rk": """select s.name, r.run_id, r.map50 as metric, nv.version,
        row_number() over (partition by s.name order by r.map50 desc nulls last, r.run_id) as rn
        from ex_scope s join runs_fx r on s.experiment = printf('exp_%d', cast(substr(r.name, 5) as int) % 10)
        left join pr_nv nv on nv.name = s.name and nv.run_id = r.run_id where r.status = 'FINISHED'""",
    "ex_best": "select * from ex_rk where rn = 1",
    "ex_champ": """select c.name, c.version as champion_version, r.map50 as champion_metric from aliases_fx c
        left join (select name, version, min(run_id) as run_id from versions_fx group by all) v on v.name = c.name and v.version = c.version
        left join runs_fx r on r.run_id = v.run_id where c.alias = 'champion'""",
    "ex_j": """select s.name, b.run_id as best_run_id, b.metric as best_metric, b.version as best_version, c.champion_version, c.champion_metric,
        (select first(k.version order by k.rn) from ex_rk k where k.name = s.name and k.version <> b.version) as challenger,
        case when b.name is null then 'error_no_runs' when b.metric is null then 'error_no_metric'
             when b.version is null then 'error_no_version' else 'ok' end as status
        from ex_scope s left join ex_best b on b.name = s.name left join ex_champ c on c.name = s.name""",
    "ex_decisions": """select *, status = 'ok' and (champion_metric is null or best_metric > champion_metric * 1.02::double) as promote,
        case when status = 'ok' then challenger end as challenger_version from ex_j""",
    # monitoring
    "bl_min": "select min(inferred_at) as t from metrics",
    "baseline": "select m.* from metrics m, bl_min where m.inferred_at < bl_min.t + interval 7 day",
    "long_m": """select date_trunc('day', inferred_at) as window_start, 'n_detections' as column_name,
            n_detections::double as value, inferred_at < t + interval 7 day as inb from metrics, bl_min where inferred_at is not null
        union all select date_trunc('day', inferred_at), 'avg_conf', avg_conf, inferred_at < t + interval 7 day
            from metrics, bl_min where inferred_at is not null""",
    "dr_tc": """select window_start, column_name, count(*) as n, avg(value) as mean from long_m
        where value is not null group by all""",
    "dr_tb": """select column_name, count(*) as baseline_n, avg(value) as baseline_mean from long_m
        where value is not null and inb group by all""",
    "dr_v": """select *, sum(cb) over (partition by column_name order by value) as rb from (
        select column_name, value, count(*) filter (where inb) as cb from long_m where value is not null group by all)""",
    "dr_e": """select distinct v.column_name, v.value as e from dr_v v join dr_tb b on v.column_name = b.column_name,
        (select unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::double[]) as q)
        where rb - cb <= floor((baseline_n - 1) * q) and floor((baseline_n - 1) * q) < rb""",
    "dr_bin": """select v.column_name, v.value, cb, (count(*) filter (where e < v.value) + count(*) filter (where e <= v.value))::int as bin
        from dr_v v left join dr_e e on v.column_name = e.column_name group by all""",
    "dr_c": """select l.window_start, l.column_name, bin, count(*) as c from long_m l
        join dr_bin b on l.column_name = b.column_name and l.value = b.value group by all""",
    "dr_b": "select column_name, bin, sum(cb) as cb from dr_bin group by all",
    "dr_ks": """select window_start, column_name, max(greatest(abs(rw / n - rb / baseline_n), abs((rw - c) / n - (rb - cb) / baseline_n))) as ks
        from (select w.*, sum(c) over (partition by window_start, column_name order by value) as rw
              from (select window_start, column_name, value, count(*) as c from long_m where value is not null group by all) w) w
        join dr_v using (column_name, value) join dr_tc using (window_start, column_name) join dr_tb using (column_name)
        group by window_start, column_name""",
    "dr_g": """select t.window_start, t.column_name, t.n, t.mean, tb.baseline_n, tb.baseline_mean, g.bin,
            greatest(coalesce(c.c, 0) / t.n, 1e-6) as p, greatest(coalesce(b.cb, 0) / tb.baseline_n, 1e-6) as q
        from dr_tc t
        join (select column_name, unnest(range(2 * count(*)::int + 1)) as bin from dr_e group by column_name) g
             on g.column_name = t.column_name
        left join dr_c c on c.window_start = t.window_start and c.column_name = t.column_name and c.bin = g.bin
        left join dr_b b on b.column_name = t.column_name and b.bin = g.bin
        left join dr_tb tb on tb.column_name = t.column_name""",
    "drift": """select window_start, column_name, max(n) as n, max(baseline_n) as baseline_n,
            max(mean) as mean, max(baseline_mean) as baseline_mean, max(mean) - max(baseline_mean) as mean_delta,
            sum((p - q) * ln(p / q)) as psi, max(ks) as ks
        from dr_g join dr_ks using (window_start, column_name)
        group by window_start, column_name""",
}

_ORDER = list(FX)


MODEL_FEATURES = """select f.frame_id, f.frame_path, f.video_id, f.timestamp_ms, m.n_detections as detection_count,
        (round(cast(m.avg_conf as double), 6) + 0.0) as mean_confidence
        from (select frame_id, printf('/frames/%s/%s.jpg', video_id, frame_id) as frame_path, video_id,
                     0::bigint as timestamp_ms from detections_fx) f
        left join (select frame_id, n_detections, avg_conf from metrics where day(inferred_at) % 4 <> 0) m
        on f.frame_id = m.frame_id"""


def _with(needs: list[str]) -> str:
    """WITH clause holding the needed fixtures and everything they depend on."""
    deps: set[str] = set()

    def add(n: str) -> None:
        if n in deps:
            return
        deps.add(n)
        body = FX[n]
        for other in _ORDER:
            if other != n and _mentions(body, other):
                add(other)

    for n in needs:
        add(n)
    parts = [f"{n} as ({FX[n]})" for n in _ORDER if n in deps]
    return "with " + ",\n".join(parts) + "\n"


def _mentions(body: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", body) is not None


def _q(needs: list[str], body: str) -> str:
    return _with(needs) + body


def _flat(list_expr: str) -> str:
    some = f"select frame_id, unnest(range(len({list_expr}))) as pos, unnest({list_expr}) as b from detections_fx"
    inner = f"select d.frame_id, s.pos, s.b from detections_fx d left join ({some}) s on d.frame_id = s.frame_id"
    return (
        f"select frame_id, pos::int as pos, {_r6('b.x1')} as x1, {_r6('b.y1')} as y1, {_r6('b.x2')} as x2, "
        f"{_r6('b.y2')} as y2, {_r6('b.conf')} as conf, b.cls as cls from ({inner})"
    )


_INTER = (
    "greatest(least(k.x2::double, b.x2::double) - greatest(k.x1::double, b.x1::double), 0.0)"
    " * greatest(least(k.y2::double, b.y2::double) - greatest(k.y1::double, b.y1::double), 0.0)"
)
_AREA_K = "((k.x2::double - k.x1::double) * (k.y2::double - k.y1::double))"
_AREA_B = "((b.x2::double - b.x1::double) * (b.y2::double - b.y1::double))"
_NMS = (
    "list_reduce(boxes, lambda acc, b: case when list_bool_or(list_transform(acc, lambda k: "
    f"k.cls = b.cls and ({_INTER}) > 0.45::double * ({_AREA_K} + {_AREA_B} - ({_INTER})))) "
    f"then acc else list_append(acc, b) end, []::{BOX}[])"
)

_INVALID = (
    "coalesce(b.x1 is null or b.y1 is null or b.x2 is null or b.y2 is null or b.conf is null or b.cls is null"
    " or b.conf < 0 or b.conf > 1 or b.x2 < b.x1 or b.y2 < b.y1, true)"
)


def _reason() -> str:
    tail = (
        f"' champion ' || {_f5('champion_metric')} || ' * 1.02 (' || {_f5('champion_metric * 1.02::double')} || ')'"
    )
    return (
        "case when status <> 'ok' then null when champion_metric is null then 'first_deploy_no_champion' "
        f"when promote then 'mAP50 ' || {_f5('best_metric')} || ' >' || {tail} "
        f"else 'mAP50 ' || {_f5('best_metric')} || ' did not beat' || {tail} end"
    )


def _decision_columns(table: str) -> str:
    return f"""select name, status, best_run_id, best_version, {_r6('best_metric')} as best_metric, champion_version,
        {_r6('champion_metric')} as champion_metric, 1.02::double as gain_gate, challenger_version,
        coalesce(challenger_version = champion_version, false) as challenger_is_champion, promote,
        case when status <> 'ok' then null when promote then 'promoted' else 'kept_champion' end as decision,
        {_reason()} as reason from {table}"""


ORACLE: dict[str, str] = {
    "video_listing": _q(
        ["files_fx"],
        f"""select path, file_name, {_stem('file_name')} as video_id
        from (select path, {_base('path')} as file_name from files_fx)
        where regexp_matches(file_name, '\\.(mp4|mov|avi)$', 'i')""",
    ),
    "frame_sampling": _q(["frames_fx"], "select video_id, frame_id, frame_path, timestamp_ms, width, height from frames_fx"),
    "frame_sampling_capped": _q(
        ["decoded_fx"],
        """select video_id, printf('%s__%06d', video_id, frame_number) as frame_id,
        printf('/frames/%s/%s__%06d.jpg', video_id, video_id, frame_number) as frame_path,
        trunc(pos_ms)::bigint as timestamp_ms, width, height
        from decoded_fx where frame_number % 30 = 0
        qualify row_number() over (partition by video_id order by frame_number) <= 2""",
    ),
    "frames_per_video": _q(["frames_fx"], "select video_id, count(*) as n_frames from frames_fx group by rollup(video_id)"),
    "decoded_ranges": _q(
        ["files_fx"],
        f"""select video_id, frame_id, '/frames/' || video_id || '/' || frame_id || '.jpg' as frame_path, timestamp_ms, width, height from (
        select video_id, printf('%s__%06d', video_id, k) as frame_id, k * 40 as timestamp_ms, (640 + length(path))::int as width, 360 as height
        from (select path, {_stem(_base('path'))} as video_id,
              unnest(range(case when clip % 500 = 0 then 4321 else clip % 40 end)) as k
              from (select path, string_split(path, '.')[2]::bigint as clip from files_fx where regexp_matches(path, '\\.(mp4|mov|avi)$', 'i')))
        where k % 7 = 0)""",
    ),
    "frame_id_from_path": _q(
        ["files_fx"],
        f"""select path, coalesce(case when doc_id % 3 = 0 then printf('given_%d', doc_id) end,
        {_stem(_base('path'))}) as frame_id from files_fx""",
    ),
    "raw_features": _q(
        ["frames_fx"],
        """select frame_id, frame_path, video_id, timestamp_ms from (
          select video_id, frame_id, frame_path, timestamp_ms, timestamp '2024-01-01 00:00:00' as extracted_at from frames_fx
          union all
          select video_id, frame_id, frame_path || '?v2', timestamp_ms, timestamp '2024-01-02 00:00:00' from frames_fx
          where timestamp_ms % 2 = 0)
        qualify row_number() over (partition by frame_id
          order by extracted_at desc, frame_path desc, video_id desc, timestamp_ms desc) = 1""",
    ),
    "duplicate_keys": """select l_orderkey, l_linenumber, count(*) as n from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "unscored_frames": _q(
        ["frames_fx", "scored_fx"],
        """select frame_id, video_id, frame_path from frames_fx f
        where not exists (select 1 from scored_fx s where s.frame_id = f.frame_id)""",
    ),
    "scored_boxes": f"""select vec_id, (row_number() over (partition by vec_id order by i) - 1)::int as box_pos,
        {_r6('x1')} as x1, {_r6('y1')} as y1, {_r6('x2')} as x2, {_r6('y2')} as y2, {_r6('conf')} as conf, cls
        from (select vec_id, i, embedding[4*i+1] as x1, embedding[4*i+2] as y1, embedding[4*i+3] as x2,
                     embedding[4*i+4] as y2, abs(embedding[4*i+4]) as conf, (embedding[4*i+3] > 0)::int as cls
              from (select vec_id, embedding, unnest(range(len(embedding) // 4)) as i from embeddings))
        where conf::double >= 0.10::double
        union all select vec_id, null, null, null, null, null, null, null from embeddings
        where len(list_filter(range(len(embedding) // 4), lambda i: abs(embedding[4*i+4])::double >= 0.10::double)) = 0""",
    "detections_provenance": _q(
        ["detections_fx", "aliases_fx"],
        """select d.frame_id, d.video_id, a.version as model_version, 'champion' as alias_used,
        coalesce(len(d.boxes), 0)::int as n_detections
        from detections_fx d cross join (select version from aliases_fx where name = 'det_2' and alias = 'champion') a""",
    ),
    "upsert_frames": _q(
        ["frames_fx"],
        """, t as (select * from frames_fx where timestamp_ms % 4 <> 3),
        s as (select video_id, frame_id, frame_path, timestamp_ms, 1280 as width, 720 as height
              from frames_fx where timestamp_ms % 4 >= 2)
        select * from t where not exists (select 1 from s where s.frame_id = t.frame_id)
        union all select * from s""",
    ),
    "snapshot_changes": _q(
        ["frames_fx"],
        """, o as (select * from frames_fx where timestamp_ms % 5 <> 0),
        n as (select video_id, frame_id, frame_path, timestamp_ms,
                     case when timestamp_ms % 3 = 0 then 1280 else width end as width, height
              from frames_fx where timestamp_ms % 7 <> 0),
        j as (select coalesce(o.frame_id, n.frame_id) as frame_id, o.frame_id is null as ins, n.frame_id is null as del,
                     o.width as old_width, n.width as new_width,
                     (o.video_id is distinct from n.video_id or o.frame_path is distinct from n.frame_path
                      or o.timestamp_ms is distinct from n.timestamp_ms or o.width is distinct from n.width
                      or o.height is distinct from n.height) as upd
              from o full outer join n on o.frame_id = n.frame_id)
        select frame_id, case when ins then 'insert' when del then 'delete' else 'update' end as change_type,
               old_width, new_width from j where ins or del or upd""",
    ),
    "detections_metrics": _q(
        ["metrics"], f"select frame_id, video_id, inferred_at, n_detections, {_r6('avg_conf')} as avg_conf from metrics"
    ),
    "detections_summary": _q(
        ["detections_fx"],
        f"""select frame_id, len(boxes)::int as n_detections,
        {_r6("round(list_sum(list_transform(boxes, lambda b: b.conf::double)) / nullif(len(boxes), 0), 3)")} as avg_conf
        from detections_fx""",
    ),
    "confs_classes": _q(
        ["detections_fx"],
        f"""select frame_id, pos::int as pos, {_r6('b.conf')} as conf, b.cls as cls
        from (select d.frame_id, s.pos, s.b from detections_fx d left join
              (select frame_id, unnest(range(len(boxes))) as pos, unnest(boxes) as b from detections_fx) s
              on d.frame_id = s.frame_id)""",
    ),
    "boxes_filtered": _q(["detections_fx"], _flat("list_filter(boxes, lambda b: b.conf >= 0.25::double)")),
    "boxes_nms": _q(["detections_fx"], _flat(_NMS)),
    "boxes_topk": _q(["detections_fx"], _flat("list_slice(boxes, 1, 3)")),
    "boxes_postprocessed": _q(
        ["detections_fx"],
        _flat("list_slice(" + _NMS.replace("list_reduce(boxes,", "list_reduce(list_filter(boxes, lambda b: b.conf >= 0.25::double),") + ", 1, 3)"),
    ),
    "box_totals": _q(
        ["metrics"],
        """select count(*) as n_frames, sum(n_detections)::bigint as total_boxes,
        first(frame_id order by n_detections desc, frame_id) as top_frame_id, max(n_detections) as top_n,
        first(printf('/frames/%s/%s.jpg', video_id, frame_id) order by n_detections desc, frame_id) as top_frame_path
        from metrics""",
    ),
    "box_contract": _q(
        ["detections_fx"],
        f""", broken as (select list_transform(boxes, lambda b: {{'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2, 'conf': b.conf,
                 'cls': case when b.cls <> 2 then b.cls end}}) as boxes from detections_fx),
        i as (select frame_id, day(inferred_at) as day from detections_fx),
        o as (select frame_id from i where day % 9 <> 0 union all select 'unknown_' || frame_id from i where day % 10 = 0)
        select count(*) as n_frames, count(*) filter (where boxes is null) as n_null_frames,
        sum(coalesce(len(boxes), 0))::bigint as n_boxes,
        sum(coalesce(len(list_filter(boxes, lambda b: {_INVALID})), 0))::bigint as n_invalid_boxes, true as schema_ok,
        (select count(*) from i) as n_in, (select count(*) from o) as n_out,
        (select count(*) from i where not exists (select 1 from o where o.frame_id = i.frame_id)) as n_lost,
        (select count(*) from o where not exists (select 1 from i where o.frame_id = i.frame_id)) as n_extra
        from broken""",
    ),
    "model_features": _q(["metrics"], MODEL_FEATURES),
    "model_features_merged": _q(["metrics"], MODEL_FEATURES),
    "predict_contract": _q(
        ["files_fx"],
        f"""select frame_id, n as n_boxes, n as n_confs, n as n_classes from (
        select coalesce(case when doc_id % 3 = 0 then printf('given_%d', doc_id) end, {_stem(_base('path'))}) as frame_id,
               case when path like '%.txt' then 0 else length(path) % 3 end::int as n from files_fx)""",
    ),
    "scoring_failures": _q(
        ["files_fx"],
        """select path, case when path like '%.txt' then 'ValueError: not a picture' end as error,
        case when path like '%.txt' then 0 else length(path) % 3 end::int as n_boxes from files_fx""",
    ),
    "pending_count": _q(
        ["frames_fx", "scored_fx"],
        "select count(*) as n_pending from frames_fx f where not exists (select 1 from scored_fx s where s.frame_id = f.frame_id)",
    ),
    "registered_versions": _q(
        ["runs_fx", "versions_fx"],
        """select r.name, r.run_id, cast(coalesce(t.top, 0) + row_number() over (partition by r.name order by r.run_id) as varchar) as version
        from runs_fx r left join (select name, max(version::bigint) as top from versions_fx group by name) t on r.name = t.name
        where not exists (select 1 from versions_fx v where v.name = r.name and v.run_id = r.run_id)""",
    ),
    "logged_runs": _q(
        ["runs_fx"],
        """select run_id, name, case when run_id % 4 >= 2 then 'FINISHED' else status end as status,
        ((map50 is not null)::int + (precision is not null)::int) as n_metrics from runs_fx""",
    ),
    "latest_run": _q(
        ["runs_fx"], "select name, run_id, status, start_time from runs_fx order by start_time desc nulls last, run_id desc limit 1"
    ),
    "run_metrics": _q(
        ["runs_fx"],
        f"""select run_id, name, status, {_r6('map50')} as map50, {_r6('precision')} as precision,
        ((map50 is not null)::int + (precision is not null)::int) as n_metrics from runs_fx""",
    ),
    "runs_ranked": _q(
        ["runs_fx"],
        f"""select name, run_id, {_r6('map50')} as metric,
        row_number() over (partition by name order by map50 desc nulls last, run_id) as rank
        from runs_fx where status = 'FINISHED'""",
    ),
    "run_versions": _q(
        ["runs_fx", "versions_fx"],
        """select r.name, r.run_id, r.status, v.version from runs_fx r
        left join (select name, run_id, max(version::bigint)::varchar as version from versions_fx group by 1, 2) v
        on r.name = v.name and r.run_id = v.run_id""",
    ),
    "champion_metric": _q(
        ["pr_champ"],
        f"select name, champion_version, champion_run_id, {_r6('champion_metric')} as champion_metric from pr_champ",
    ),
    "promotion_gate": _q(["decisions"], _decision_columns("decisions")),
    "promotion_by_experiment": _q(["ex_decisions"], _decision_columns("ex_decisions")),
    "alias_moves": _q(
        ["decisions", "aliases_fx"],
        """, upd as (select name, 'champion' as alias, best_version as version from decisions where promote
                     union all
                     select name, 'challenger', challenger_version from decisions where challenger_version is not null)
        select name, alias, version from aliases_fx a
        where not exists (select 1 from upd u where u.name = a.name and u.alias = a.alias)
        union all select name, alias, version from upd""",
    ),
    "decision_tags": _q(
        ["decisions"],
        """select name, best_run_id as run_id,
        case when status <> 'ok' then null when promote then 'promoted' else 'kept_champion' end as promotion_decision,
        2 as n_tags from decisions where status = 'ok'""",
    ),
    "baseline_window": _q(
        ["baseline"], f"select frame_id, video_id, inferred_at, n_detections, {_r6('avg_conf')} as avg_conf from baseline"
    ),
    "daily_profile": _q(
        ["long_m"],
        f"""select window_start, column_name, count(*) as n, count(*) filter (where value is null) as n_null,
        count(distinct value) as n_distinct, {_r6('avg(value)')} as mean, {_r6('stddev_samp(value)')} as stddev,
        {_r6('min(value)')} as min, {_r6('max(value)')} as max,
        {_r6('quantile_cont(value, 0.25)')} as p25, {_r6('quantile_cont(value, 0.5)')} as p50,
        {_r6('quantile_cont(value, 0.75)')} as p75
        from long_m group by window_start, column_name""",
    ),
    "drift_vs_baseline": _q(
        ["drift"],
        f"""select window_start, column_name, n, baseline_n, {_r6('mean')} as mean, {_r6('baseline_mean')} as baseline_mean,
        {_r6('mean_delta')} as mean_delta, {_r6('psi')} as psi, {_r6('ks')} as ks from drift""",
    ),
    "drift_flags": _q(
        ["drift", "aliases_fx"],
        f"""select d.window_start, d.column_name, {_r6('d.psi')} as psi, a.name, a.alias, a.version as flagged_version
        from drift d cross join (select name, alias, version from aliases_fx
                                 where name = 'det_2' and alias = 'champion') a
        where d.psi > 0.2""",
    ),
    "incremental_scoring": """select printf('vec_%d__%06d', vec_id, 0) as frame_id, printf('label_%d', label) as video_id,
        coalesce(len(list_filter(range(len(embedding) // 4), lambda i: abs(embedding[4*i+4])::double >= 0.10::double)), 0)::int
            as n_detections,
        case when vec_id % 2 = 0 then '1' else '2' end as model_version, 'champion' as alias_used
        from embeddings""",
}

# The same results by another way of the library.
ORACLE |= {"monitor_refresh": ORACLE["drift_vs_baseline"], "upsert_frames_table": ORACLE["upsert_frames"], "snapshot_feed": ORACLE["snapshot_changes"]}
