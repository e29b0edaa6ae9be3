"""DuckDB SQL of the registered queries, over the driver tables."""

_WORDS = r"""
w0 as (select conv_id, turn, role, unnest(range(len(a))) as idx, unnest(a) as text from (select conv_id, turn, role, list_filter(regexp_split_to_array(text,'[ \t\n\r]+'), lambda x: x<>'') a from conversations)),
h as (select *, length(text) n_ch, (conv_id*7919+turn*104729+idx*1299709)%1000 h, (conv_id*131+turn*37+idx*17)%100 c, (conv_id*31+turn*17+idx//3)%60 g from w0),
t0 as (select *, case when n_ch<=2 then 41+h%60 else 60+n_ch*55+h%120 end dur, case when idx=0 then 300+h%900 else 20+h%60+case when h%37=0 then 700 else 0 end end gap from h),
p0 as (select *, cast(sum(dur+gap) over (partition by conv_id order by turn,idx rows between unbounded preceding and current row) as bigint) b_end from t0),
q0 as (select *, b_end-dur b_start from p0),
r0 as (select *, first_value(b_start) over (partition by conv_id,turn,idx//3 order by idx) g_start, count(*) over (partition by conv_id,turn,idx//3) g_n from q0),
words as (select conv_id programme_id, turn segment_id, idx word_index, role, text, b_start ps,
  case when (g=0 and g_n=3 and (idx//3)%2=0) or c=4 then b_start+3 else b_end end pe,
  case when g=0 and g_n=3 then g_start when c in (0,4) then b_start-3000 when c=52 then b_start+4000 else b_start+(h%7)-3 end s,
  case when g=0 and g_n=3 then g_start+1 when c=1 then b_start+(h%7)-3+10 when c=52 then b_end+4000 when c=3 then b_start+(h%7)-3+case when n_ch<=2 then 39 else 25 end else b_end+(h%5)-2 end e from r0)"""

_RULES = r""",
m1 as (select *, pe-ps pd, greatest(length(regexp_replace(text,'\s+','','g')),1) nc from words),
m2 as (select *, greatest(1500, cast(floor(nc*1000.0/14*2.5+0.5) as bigint)) max_ms, coalesce(pd>=40 and pd >= nc*1000.0/14/2.5, false) credible from m1),
rules as (select *, case when credible then least(max_ms, cast(floor(pd*2.5+40+0.5) as bigint)) else max_ms end ceiling, coalesce(pd>0 and pd<=100,false) near_zero from m2)"""

_DISPUTED = r""",
d0 as (select *, case when s = lag(s) over o and e = lag(e) over o then 0 else 1 end nw from rules window o as (partition by programme_id order by segment_id, word_index)),
d2 as (select *, sum(nw) over (partition by programme_id order by segment_id, word_index) island from d0),
d3 as (select *, count(*) over (partition by programme_id, island) >= 3 stacked, greatest(abs(s-ps),abs(e-pe)) divergence from d2),
flagged as (select *, case when e is null or s is null then false when stacked then true when divergence>1500 then true when e-s>ceiling then true when pd is null then false
  when e-s>=40 then false when e-s<0 then false when not (pd>=40 and pd<=max_ms) then false when e-s<16 then true else not near_zero end disputed from d3)"""

_FOLD = r""",
f1 as (select *, case when disputed is distinct from lag(disputed) over o or segment_id is distinct from lag(segment_id) over o then 1 else 0 end ch,
  max(case when not disputed then e end) over (partition by programme_id order by segment_id, word_index rows between unbounded preceding and 1 preceding) bef,
  first_value(case when not disputed then s end ignore nulls) over (partition by programme_id order by segment_id, word_index rows between 1 following and unbounded following) nxt
  from flagged window o as (partition by programme_id order by segment_id, word_index)),
f2 as (select *, sum(ch) over (partition by programme_id order by segment_id, word_index) run from f1),
f3 as (select *, lag(pe) over r ppe, row_number() over r k, count(*) over (partition by programme_id, run) kn from f2 where disputed window r as (partition by programme_id, run order by word_index)),
f4 as (select *, case when k=kn then pe-nxt end tail from f3),
f5 as (select *, case when tail>0 and tail<=250 then nxt else pe end pend from f4),
f6 as (select programme_id, run, min(segment_id) segment_id, bool_and(not stacked and e-s>=40 and e-s<=ceiling) aok,
  bool_and(pd>=40 and pd<=max_ms and pend-ps>=40 and pend-ps<=max_ms and coalesce(ps>=ppe,true) and coalesce(tail<=250,true)) pok,
  min(case when k=1 then least(ps+250, pend-40) end) t, min(case when k=1 then bef end) bef, max(pend) pmax, max(e) amax from f5 group by programme_id, run),
f7 as (select *, row_number() over (partition by programme_id order by run) n from f6),
fold as (select programme_id, run, n, pok and not aok and coalesce(bef<=t,true) restored, aok, bef fin,
    greatest(bef, case when pok and not aok and coalesce(bef<=t,true) then pmax else amax end) f from f7 where n=1
  union all select x.programme_id, x.run, x.n, x.pok and not x.aok and coalesce(greatest(y.f,x.bef)<=x.t,true), x.aok, greatest(y.f,x.bef),
    greatest(y.f, x.bef, case when x.pok and not x.aok and coalesce(greatest(y.f,x.bef)<=x.t,true) then x.pmax else x.amax end)
  from f7 x join fold y on x.programme_id=y.programme_id and x.n=y.n+1),
arb0 as (select w.*, z.restored, z.aok, z.fin, g.pend, g.k from f2 w left join fold z on w.programme_id=z.programme_id and w.run=z.run and w.disputed
  left join f5 g on w.programme_id=g.programme_id and w.segment_id=g.segment_id and w.word_index=g.word_index),
arb as (select programme_id, segment_id, word_index, text, ps, pe, pd, max_ms, near_zero, credible, ceiling, divergence, e-s adur,
  case when not disputed then 'undisputed' when restored then 'restored' when aok then 'provider_timing_rejected' when stacked then 'alignment_collapsed' else 'unresolved' end outcome,
  case when coalesce(restored,false) then (case when k=1 and fin>ps then fin else ps end) else s end s, case when coalesce(restored,false) then pend else e end e from arb0),
cl0 as (select *, max(e) over (partition by programme_id order by segment_id, word_index rows between unbounded preceding and 1 preceding) be from arb),
cl as (select * exclude (s), s s0, case when e>s and outcome not in ('restored','alignment_collapsed') and e-s>max_ms then greatest(e-max_ms, greatest(be,s)) else s end s from cl0),
refined as (select *, s-s0 absorbed, case when e-s>=40 then 'untouched' when e-s<=0 then 'zero_width_final_window' when near_zero then 'corroborated' else 'final_window_below_evidence_floor_uncorroborated' end final from cl)"""

_TURNS = r""",
segs as (select programme_id, segment_id, role, min(ps) start_ms, max(pe) end_ms, case role when 'user' then 0 when 'assistant' then 1 else 2 end n from words group by all),
turns as (select programme_id, segment_id, 'SPEAKER_0'||n cluster, start_ms-100 start_ms, end_ms+(segment_id*97)%400 end_ms, ((segment_id*37)%100)::double confidence from segs where (programme_id+segment_id)%11<>0
  union all select programme_id, segment_id, 'SPEAKER_0'||((n+1)%3), end_ms-(end_ms-start_ms)//3, end_ms+50, ((segment_id*37)%100)::double from segs where (programme_id+segment_id)%4=0
  union all select programme_id, segment_id, 'SPEAKER_0'||((n+2)%3), start_ms-150, start_ms+300, ((segment_id*37)%100)::double from segs where (programme_id+segment_id)%9=0 and (programme_id+segment_id)%11<>0)"""

_EVENTS = r"""
ev as (select event_id, user_id%150 job_id, 'q'||(user_id%31) queue, case event_type when 'signup' then 'waiting' when 'click' then 'active' when 'view' then 'completed' when 'error' then 'failed' when 'purchase' then 'delayed' end state,
  ts, cast(json_extract_string(props,'$.k') as bigint) k, value from events),
jobs as (select *, k%4 attempt, (['HTTP 429','HTTP 503','fetch failed','HTTP 403: auth_required','without usable speech',''])[cast(k%6+1 as int)] message from ev)"""

_KEY = "programme_id, segment_id, word_index"
_W = "with recursive " + _WORDS

ORACLES = {
    "prd_word_rules": _W + _RULES + f" select {_KEY}, max_ms, credible, ceiling, near_zero, (e-s>=40 and e-s<=ceiling) plausible from rules",
    "prd_08_disputed": _W + _RULES + _DISPUTED + f" select {_KEY}, stacked, divergence, disputed from flagged",
    "fold_01_arbitration": _W + _RULES + _DISPUTED + _FOLD + f""" select {_KEY}, outcome, s, e, case when outcome='restored' then (case when adur<40 then 'aligned_window_below_evidence_floor' else 'aligned_window_inflated_beyond_evidence' end)
        when outcome='provider_timing_rejected' then (case when pd is not null and not credible then 'provider_capture_too_short_to_be_credible' else 'provider_capture_not_a_possible_utterance' end) when outcome='unresolved' then 'neither_timeline_usable_dispute_unresolved' end arbitration_reason,
        case when outcome in ('restored','provider_timing_rejected','unresolved') then ceiling end arbitration_ceiling_ms, case when outcome in ('restored','provider_timing_rejected','unresolved') then pd end arbitration_provider_ms, case when outcome in ('restored','provider_timing_rejected','unresolved') then adur end arbitration_aligned_ms from arb""",
    "pipe_01_refine_timing": _W + _RULES + _DISPUTED + _FOLD + f" select {_KEY}, outcome, final, s, e, absorbed from refined",
    "agg_05_outcomes": _W + _RULES + _DISPUTED + _FOLD + " select programme_id, outcome, final, count(*) n_words, cast(sum(absorbed) as bigint) absorbed_ms from refined group by all",
    "jn_01_points_in_turns": _W + _TURNS + f" select w.programme_id, w.segment_id, w.word_index, t.cluster, t.start_ms from words w join turns t on w.programme_id=t.programme_id and w.s>=t.start_ms and w.s<t.end_ms",
    "jn_02_best_overlap": _W + _TURNS + f""", o as (select w.programme_id, w.segment_id, w.word_index, t.cluster, least(w.e,t.end_ms)-greatest(w.s,t.start_ms) overlap_ms,
        row_number() over (partition by w.programme_id, w.segment_id, w.word_index order by least(w.e,t.end_ms)-greatest(w.s,t.start_ms) desc, t.start_ms, t.end_ms, t.cluster desc) k
        from words w join turns t on w.programme_id=t.programme_id and least(w.e,t.end_ms)>greatest(w.s,t.start_ms))
        select w.programme_id, w.segment_id, w.word_index, o.cluster, o.overlap_ms from words w left join o on o.k=1 and w.programme_id=o.programme_id and w.segment_id=o.segment_id and w.word_index=o.word_index""",
    "agg_01_speaker_plan": _W + _TURNS + """, g as (select programme_id, cluster, min({'a': start_ms, 'b': end_ms}) f, avg(greatest(0.0, least(1.0, case when confidence>1 then confidence/100 else confidence end))) m, count(*) turn_count from turns group by all),
        i as (select *, row_number() over (partition by programme_id order by f, cluster)-1 speaker_index from g)
        select programme_id, cluster, speaker_index, speaker_index%8 colour, floor(m*1e6+0.5)/1e6 mean_confidence, turn_count from i""",
    "win_05_sentences": _W + r""", c as (select *, case when coalesce(regexp_matches(lag(text) over o, '[.!?…。！？]["''”’)\]]*$') or ps - lag(pe) over o >= 650, false) then 1 else 0 end cut from words window o as (partition by programme_id, segment_id order by word_index)),
        d as (select *, cast(sum(cut) over (partition by programme_id, segment_id order by word_index) as bigint) piece from c)
        select programme_id, segment_id, piece, min(ps) start_ms, max(pe) end_ms, count(*) n_words, trim(regexp_replace(regexp_replace(string_agg(trim(text),' ' order by word_index),'\s+([,.;:!?])','\1','g'),'\s+',' ','g')) as text from d group by all""",
    "win_12_stems": _W + _TURNS + """, c as (select programme_id, role speaker_id, segment_id clip_no, end_ms-start_ms d from segs),
        k as (select *, cast(coalesce(sum(d+500) over (partition by programme_id, speaker_id order by clip_no rows between unbounded preceding and 1 preceding),0) as bigint) start_ms from c)
        select programme_id, speaker_id, clip_no, start_ms, start_ms+d end_ms, greatest(1, max(start_ms+d) over (partition by programme_id, speaker_id)) total_ms from k""",
    "prd_12_overruns": _W + _TURNS + " select programme_id, count(*) late_clips from segs where (programme_id*13+segment_id*7)%160-40>80 group by all",
    "agg_11_shift_gate": _W + """, d as (select programme_id, segment_id, word_index, greatest(abs(s-ps),abs(e-pe))::double d from words), g as (select programme_id, count(*) word_count, quantile_cont(d,0.5) median_shift, quantile_cont(d,0.95) p95_shift, quantile_cont(d,0.99) p99_shift, max(d) max_shift, count(*) filter (d>1500) outliers,
        coalesce(array_to_string(list_slice(list(segment_id||':'||word_index order by d desc, segment_id, word_index) filter (d>1500),1,5),','),'') outlier_sample from d group by programme_id)
        select *, case when p99_shift is null then 'unmeasured' when p99_shift>30000 then 'p99_shift' when outliers/word_count>0.005 then 'outlier_ratio' else 'pass' end verdict from g""",
    "fn_texts": r"""select conv_id, turn, lpad(cast(m//3600000 as varchar),2,'0')||':'||lpad(cast(m//60000%60 as varchar),2,'0')||':'||lpad(cast(m//1000%60 as varchar),2,'0')||';'||lpad(cast(m%1000//40 as varchar),2,'0') tc,
        not regexp_matches(text,'[\p{L}\p{N}]') punct, substr(regexp_replace(text,'[^A-Za-z0-9]','_','g'),1,40) slug, regexp_matches(text,'[.!?…。！？]["''”’)\]]*$') ends, len(list_filter(regexp_split_to_array(trim(text),'\s+'), lambda x: x<>'')) n_words from (select *, conv_id*7919+turn*104729 m from conversations)""",
    "agg_15_queue_states": "with " + _EVENTS + " select queue, state, count(*) jobs from (select queue, job_id, arg_max(state, {'a': ts, 'b': event_id}) state from jobs group by all) group by all",
    "win_13_recent": "with " + _EVENTS + " select queue, state, rank, event_id from (select *, row_number() over (partition by queue, state order by ts desc, event_id desc) rank from jobs) where rank<=10",
    "prd_17_failures": "with " + _EVENTS + """ select case when contains(message,'429') then 'rate_limited' when regexp_matches(message,'50[234]|524') then 'gateway_timeout' when contains(message,'403') then 'auth_rejected' when regexp_matches(message,'(?i)fetch failed|timeout|socket') then 'transient' when message='' then 'none' else 'terminal' end failure,
        count(*) n, cast(sum(cast(least(20000.0, 1000*pow(2.0, attempt)) as bigint)) as bigint) backoff_ms from jobs where state='failed' group by all""",
    "stm_03_start_rates": "with " + _EVENTS + " select queue, time_bucket(interval '1 hour', ts, timestamp '1970-01-01') window_start, count(*) starts, count(*)>2 as \"over\" from jobs where state='active' group by 1,2",
    "stm_04_wait_trend": "with " + _EVENTS + """ select queue, b - interval (o) hour window_start, count(*) n_events, max(value) longest, floor(avg(value) filter (state in ('waiting','delayed'))*1000+0.501)/1000 mean_wait, floor(avg(value) filter (state not in ('waiting','delayed'))*1000+0.501)/1000 mean_work from (select *, time_bucket(interval '1 hour', ts, timestamp '1970-01-01') b from jobs), (values (0),(1)) x(o) group by 1,2""",
    "stm_05_sessions": "with " + _EVENTS + """, l as (select *, case when coalesce(epoch_us(ts)-epoch_us(lag(ts) over (partition by job_id order by ts, event_id))>3600000000, true) then 1 else 0 end nw from jobs),
        m as (select *, cast(sum(nw) over (partition by job_id order by ts, event_id) as bigint) session from l) select job_id, session, count(*) n_events from m group by all""",
}
