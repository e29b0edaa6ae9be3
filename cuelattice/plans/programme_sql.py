"""DuckDB SQL of the programme queries, as one chain of named steps."""

from ..operators import audit, islands
from .oracles import _DISPUTED, _FOLD, _RULES, _TURNS, _W

_P = "partition by programme_id"
_PS = "partition by programme_id, segment_id order by word_index"
_SEQ = "partition by programme_id order by sequence_index"

_REC = r""",
rc0 as materialized (select *, case when k%10<>0 then (k%64)/64.0::double end conf, case when k%211=0 then 300+k%700 else 0 end exp_, case when k%211=0 then 2 else 1 end pas, k%331=0 bad, case when k%331<>0 then '' when k%5=0 then 'search_region_exhausted' else 'no_acoustic_match' end er, (programme_id+segment_id*3+word_index*7)%1201=0 exhausted,
  final in ('zero_width_final_window','final_window_below_evidence_floor_uncorroborated') below from (select *, programme_id*17+segment_id*29+word_index*13 k from refined)),
rc1 as (select *, below or outcome='unresolved' or bad u0, case when below then final when outcome='unresolved' then (case when er<>'' then er else 'arbitration_unresolved_two_timeline_conflict' end) else er end r0 from rc0),
rc2 as (select *, case when u0 and outcome<>'alignment_collapsed' and not exhausted and e-s>=16 and not (r0 in ('zero_width_final_window','alignment_collapse_no_usable_window','arbitration_unresolved_two_timeline_conflict')
    or starts_with(r0,'search_region_exhausted') or starts_with(r0,'final_window_below_evidence_floor'))
  then case when outcome='restored' and e-s>=40 and e-s<=max_ms then 'resolved_by_capture_restore' when final='corroborated' and pd>0 then 'resolved_by_provider_corroboration' end end cleared from rc1),
rec as materialized (select *, u0 and cleared is null unresolved, case when cleared is null then r0 else '' end reason, case when cleared is not null then r0 end prior_reason from rc2)"""

_ATTR = _TURNS + rf""",
st as (select programme_id, segment_id, start_ms, end_ms, source_text, status, is_music, not (is_music or (k%7=0 and k%21=0)) has_words, case when k%5=0 then start_ms-40 end cs, case when k%5=0 then end_ms+40 end ce, k%5=0 refined_before, k%41=0 override
  from (select s.*, c.text source_text, s.role='system' is_music, k, case when k%7=0 then 'edited' when k%13=0 then 'approved' else 'machine' end status from (select *, programme_id+segment_id k from segs) s join conversations c on c.conv_id=s.programme_id and c.turn=s.segment_id)),
pl as (select programme_id, cluster, row_number() over ({_P} order by f, cluster)-1 speaker_index from (select programme_id, cluster, min({{'a': start_ms, 'b': end_ms}}) f from turns group by all)),
spans as (select programme_id, segment_id, word_index, s, e from rec union all select programme_id, segment_id, -1, start_ms, end_ms from st where not has_words),
bo as (select * from (select w.programme_id, w.segment_id, w.word_index, t.cluster, row_number() over (partition by w.programme_id, w.segment_id, w.word_index order by least(w.e,t.end_ms)-greatest(w.s,t.start_ms) desc, t.start_ms, t.end_ms, t.cluster desc) k
  from spans w join turns t on w.programme_id=t.programme_id and least(w.e,t.end_ms)>greatest(w.s,t.start_ms)) where k=1),
w1 as (select r.*, o.cluster, x.status in ('edited','approved') whole, p.cluster first_cluster from rec r join st x on r.programme_id=x.programme_id and r.segment_id=x.segment_id and x.has_words
  left join bo o on r.programme_id=o.programme_id and r.segment_id=o.segment_id and r.word_index=o.word_index left join pl p on p.programme_id=r.programme_id and p.speaker_index=0),
w2 as (select *, lead(cluster) over ({_PS}) nx from w1),
w3 as (select *, coalesce(last_value(cluster ignore nulls) over (o rows between unbounded preceding and current row), first_value(coalesce(cluster,nx,first_cluster)) over (o rows between unbounded preceding and current row)) filled from w2 window o as ({_PS})),
w4 as (select *, case when filled<>lag(filled) over ({_PS}) then 1 else 0 end ch from w3),
w5 as (select *, cast(sum(ch) over ({_PS}) as bigint) g0 from w4),
w6 as materialized (select *, max(g0) over (partition by programme_id, segment_id)+1 n_groups, case when whole then 0 else g0 end group_no, greatest(abs(s-ps),abs(e-pe)) shift from w5),
dom as (select *, row_number() over (partition by programme_id, segment_id, group_no order by ms desc, at_) k from (select programme_id, segment_id, group_no, filled cluster, sum(greatest(0,e-s)) ms, min(word_index) at_ from w6 group by all)),
gr as (select programme_id, segment_id, group_no, count(*) n_words, arg_min(s,word_index) ws, arg_max(e,word_index) we, max(n_groups) n_groups, min(s) filter (not unresolved) core_start, max(e) filter (not unresolved) core_end,
  count(*) filter (unresolved) unresolved_words, count(*) filter (exhausted) exhausted_words, count(*) filter (starts_with(reason,'final_window_below_evidence_floor') or reason='zero_width_final_window') near_zero_words,
  count(*) filter (cleared is not null) cleared_words, count(*) filter (cluster is null) uncovered_words, max(absorbed) absorbed_ms, max(shift) max_shift_ms, coalesce(max(shift) filter (outcome<>'provider_timing_rejected'),0) gap_ms,
  bool_or(outcome='restored') restored, bool_or(outcome='provider_timing_rejected') rejected, bool_or(outcome='alignment_collapsed') collapsed, bool_or(absorbed>0) onset_moved, arg_max(pe,word_index)-arg_min(ps,word_index) capture_ms, max(greatest(s,ps)) lws, count(*) filter (starts_with(reason,'final_window_below_evidence_floor')) below_floor_words, avg(conf) mean_confidence, max(exp_) expansion_ms, max(pas) alignment_pass, coalesce(max(divergence) filter (outcome='restored'),0) restored_ms, coalesce(max(divergence) filter (outcome='provider_timing_rejected'),0) rejected_ms,
  trim(regexp_replace(regexp_replace(string_agg(trim(text),' ' order by word_index),'\s+([,.;:!?])','\1','g'),'\s+',' ','g')) mt from w6 group by all),
u1 as (select x.programme_id, x.segment_id, g.group_no, d.cluster, n_words, ws s_, we e_, n_groups>1 and x.status='machine' split, n_groups>1 and x.status<>'machine' span_unresolved, core_start, core_end, unresolved_words, exhausted_words, near_zero_words, cleared_words, uncovered_words,
    absorbed_ms, max_shift_ms, gap_ms, restored, rejected, collapsed, onset_moved, capture_ms, lws, below_floor_words, mean_confidence, expansion_ms, alignment_pass, restored_ms, rejected_ms, case when x.status<>'machine' and trim(source_text)<>'' then source_text when mt<>'' then mt else source_text end as text, x.* exclude (programme_id, segment_id)
    from gr g join st x on g.programme_id=x.programme_id and g.segment_id=x.segment_id join dom d on d.k=1 and d.programme_id=g.programme_id and d.segment_id=g.segment_id and d.group_no=g.group_no
  union all select x.programme_id, x.segment_id, 0, coalesce(o.cluster,p.cluster), 0, start_ms, end_ms, false, false, null, null, 0,0,0,0,0,0,0,0, false,false,false,false, null, null, 0, null, 0, null, 0, 0, source_text, x.* exclude (programme_id, segment_id)
    from st x left join bo o on o.programme_id=x.programme_id and o.segment_id=x.segment_id and o.word_index=-1 left join pl p on p.programme_id=x.programme_id and p.speaker_index=0 where not has_words),
rows_ as materialized (select u.* exclude (start_ms, end_ms, s_, e_), s_ start_ms, e_ end_ms, case when split then null when ce>cs then cs when refined_before then null when u.end_ms>u.start_ms then u.start_ms end pb_start,
  case when split then null when ce>cs then ce when refined_before then null when u.end_ms>u.start_ms then u.end_ms end pb_end, n_words=0 and not is_music authored_preserved, pl.speaker_index,
  row_number() over (partition by u.programme_id order by s_, e_, segment_id, group_no)-1 sequence_index from u1 u left join pl on pl.programme_id=u.programme_id and pl.cluster=u.cluster)"""

_BOUNDS = rf""",
b0 as (select *, core_start is not null has_core, coalesce(core_start is null and n_words>0 and pb_end>pb_start and pb_start>=0, false) recovered from rows_),
b1 as (select *, case when recovered then pb_start else start_ms end s0, case when recovered then pb_end else end_ms end e0 from b0),
b2 as (select *, lag(coalesce(core_end,e0)) over ({_SEQ}) pv, lead(coalesce(core_start,start_ms)) over ({_SEQ}) nx from b1),
b3 as (select *, cast(floor(least(120.0, greatest(0.0, case when pv is null then core_start::double else (core_start-pv)/2 end))+0.5) as bigint) li, cast(floor(least(200.0, case when nx is null then 200.0 else greatest(0.0,(nx-core_end)/2) end)+0.5) as bigint) lo from b2),
b4 as (select *, case when core_end+lo>nx then greatest(core_end,nx) else core_end+lo end en from b3),
b5 as (select *, has_core and coalesce(pb_end>=core_end and abs(pb_end-en)<=150 and coalesce(pb_end<=nx,true),false) ke from b4),
b6 as (select *, case when not has_core then e0 when ke then pb_end else en end fe from b5),
b7 as (select *, lag(fe) over ({_SEQ}) fence from b6),
b8 as (select *, greatest(0, case when fence>core_start-li then least(core_start,fence) else core_start-li end) st_ from b7),
b9 as (select *, has_core and coalesce(pb_start<=core_start and abs(pb_start-st_)<=150 and coalesce(pb_start>=fence,true) and pb_start>=0,false) ks from b8),
b10 as (select *, case when not has_core then s0 when ks then pb_start else st_ end fs from b9),
b11 as (select * exclude (start_ms, end_ms), fs start_ms, fe end_ms, case when ks and ke then 'validated_words_stable' when has_core then 'validated_words' when n_words>0 then 'unresolved_words_preserved' when authored_preserved then 'authored_preserved' else 'music_preserved' end boundary,
  case when has_core then greatest(0,core_start-fs) else 0 end lead_in_ms, case when has_core then greatest(0,fe-core_end) else 0 end lead_out_ms, fs-start_ms delta_start_ms, fe-end_ms delta_end_ms,
  has_core and (coalesce(pb_start>core_start,false) or coalesce(pb_end<core_end,false)) contradicted from b10),
bounds as materialized (select *, greatest(0, coalesce(lag(start_ms) over o - start_ms,0), coalesce(start_ms - lead(start_ms) over o,0)) conflict_ms from b11 window o as ({_SEQ}))"""

_ISLANDS = rf""",
i0 as (select *, lag(cluster) over o pc, lead(cluster) over o nc, lag(is_music) over o pm, lead(is_music) over o nm, start_ms-lag(end_ms) over o gb0, lead(start_ms) over o - end_ms ga0, lag(text) over o pt, lead(text) over o nt,
  list_filter(string_split(trim(text),''), lambda c: lower(c)<>upper(c))[1] fc from bounds window o as ({_SEQ})),
i1 as (select *, greatest(0,gb0) gb, greatest(0,ga0) ga, coalesce(not pm and pc<>cluster,false) cp, coalesce(not nm and nc<>cluster,false) cn, regexp_matches(regexp_replace(regexp_replace(text,'[\s\x0B\x{{85}}\pZ\x{{FEFF}}]+$',''),'["''”’»)\]]+$',''),'[.!?…。！？؟।]$') es, regexp_matches(regexp_replace(regexp_replace(pt,'[\s\x0B\x{{85}}\pZ\x{{FEFF}}]+$',''),'["''”’»)\]]+$',''),'[.!?…。！？؟।]$') pes,
  lead(fc) over ({_SEQ}) nfc from i0),
i2 as (select *, coalesce(not is_music and cluster is not null and n_words between 1 and 2 and end_ms-start_ms<=400,false) atomic, coalesce(gb0 is not null and gb<=300,false) or coalesce(ga0 is not null and ga<=300,false) seam, cp and cn and coalesce(pc=nc,false) sw,
  cn and ga<=300 and not es and coalesce(nfc=lower(nfc),false) fw, cp and gb<=300 and not pes and coalesce(fc=lower(fc),false) bw from i1),
i3 as (select *, fw or bw att, fw or (not bw and sw) tn from i2),
i4 as (select *, case when atomic then (case when tn then nc else pc end) end target, coalesce(case when tn then case when ga0 is not null then ga end else case when gb0 is not null then gb end end <=40,false) contact from i3),
near_ as (select i.programme_id, i.sequence_index, i.cluster, i.target, i.start_ms, i.end_ms, t.cluster tc, t.start_ms ts, t.end_ms te from i4 i join turns t on t.programme_id=i.programme_id and t.end_ms>i.start_ms-400 and t.start_ms<i.end_ms+400 where i.target<>i.cluster),
ov as (select programme_id, sequence_index, max(o) o from (select programme_id, sequence_index, least(end_ms,te)-greatest(start_ms,ts) o from near_ where tc=target
  union all select a.programme_id, a.sequence_index, least(a.te,b.te)-greatest(a.ts,b.ts) from near_ a join near_ b on a.programme_id=b.programme_id and a.sequence_index=b.sequence_index where a.tc=a.target and b.tc=b.cluster) group by all),
i5 as (select i.*, greatest(0,coalesce(o,0)) overlap_ms from i4 i left join ov on ov.programme_id=i.programme_id and ov.sequence_index=i.sequence_index),
i6 as (select *, overlap_ms>=100 ovr, target is not null and atomic and ((att and (sw or overlap_ms>=100 or contact)) or (sw and case when overlap_ms>=100 then seam or att else seam and att end)) island from i5),
isl as materialized (select *, case when island then target end suggested, case when island then array_to_string(list_filter(['atomic_row', case when att then 'directional_attachment' end, case when att then (case when tn then 'attached_to_next' else 'attached_to_previous' end) end, case when sw then 'same_speaker_sandwich' end,
  case when seam then 'sub_seam_gap_to_neighbour' end, case when contact then 'contact_seam' end, case when ovr then 'competing_speaker_activity' end, case when att then 'lexical_continuity' end], lambda x: x is not null),',') end signals from i6)"""

_AUDIT = r""",
o0 as (select *, case when not is_music and not rejected then greatest(0, coalesce(end_ms-start_ms-capture_ms,0)) else 0 end inflation_ms from isl),
o1 as (select *, case when is_music then 0 else greatest(gap_ms,inflation_ms) end divergence_ms, not is_music and unresolved_words+exhausted_words>0 unplaced, not is_music and collapsed col from o0),
own as materialized (select *, case when conflict_ms>0 or unplaced then 'unresolved_timing' when col then 'alignment_collapse' when divergence_ms>1500 then 'provider_capture_divergence' end d0, case when conflict_ms>0 then conflict_ms when unplaced or col then 0 when divergence_ms>1500 then divergence_ms end dm0,
  row_number() over (partition by programme_id, cluster order by start_ms, end_ms, sequence_index) n from o1),
sweep as (select programme_id, cluster, n, sequence_index, start_ms fs, end_ms fe, sequence_index fi, coalesce(lws,-1) fw, null::bigint other, 0::bigint ov, false fix from own where n=1
  union all select programme_id, cluster, n, sequence_index, case when end_ms>ae then start_ms else fs end, case when end_ms>ae then end_ms else ae end, case when end_ms>ae then sequence_index else fi end, case when end_ms>ae then lws_ else fw end, fi, ov, fix
  from (select *, case when fix then start_ms else fe end ae from (select r.programme_id, r.cluster, r.n, r.sequence_index, r.start_ms, r.end_ms, coalesce(r.lws,-1) lws_, s.fs, s.fe, s.fi, s.fw, s.fe-r.start_ms ov, s.fe-r.start_ms>10 and s.fe-r.start_ms<=250 and r.start_ms>s.fs and s.fw<r.start_ms fix
    from own r join sweep s on r.programme_id=s.programme_id and r.cluster is not distinct from s.cluster and r.n=s.n+1))),
hits as materialized (select programme_id, sequence_index, other other_index, ov overlap_ms, fix repaired from sweep where ov>10 and n>1),
pull as (select h.programme_id, h.other_index sequence_index, min(r.start_ms) ne from hits h join own r on r.programme_id=h.programme_id and r.sequence_index=h.sequence_index where repaired group by all),
sides as (select h.programme_id, unnest([h.sequence_index,h.other_index]) sequence_index, h.overlap_ms, {'a': r.start_ms, 'b': r.end_ms, 'c': r.sequence_index} at_ from hits h join own r on r.programme_id=h.programme_id and r.sequence_index=h.sequence_index where not repaired),
mk as (select programme_id, sequence_index, arg_min(overlap_ms,at_) o from sides group by all),
aud as materialized (select w.* exclude (end_ms), coalesce(ne,end_ms) end_ms, ne is not null repaired, case when mk.o is not null and d0 is distinct from 'unresolved_timing' then 'same_speaker_overlap' else d0 end defect, case when mk.o is not null and d0 is distinct from 'unresolved_timing' then mk.o else dm0 end defect_ms
  from own w left join pull p on p.programme_id=w.programme_id and p.sequence_index=w.sequence_index left join mk on mk.programme_id=w.programme_id and mk.sequence_index=w.sequence_index)"""

_STATES = r""",
z0 as (select *, case when authored_preserved then 'unmeasured_text' when unresolved_words>0 then 'unplaced_words' when exhausted_words>0 then 'window_edge' when near_zero_words>0 then 'too_short' when collapsed or defect='alignment_collapse' then 'collapse' when defect='same_speaker_overlap' then 'overlap' when conflict_ms>0 then 'chronology' when defect='provider_capture_divergence' then 'divergence' end tm,
  case when uncovered_words>0 then 'no_turn' when span_unresolved and not island then 'several_speakers' when island then 'island' end sp,
  array_to_string(list_filter([case when rejected then 'provider_timing_rejected' end, case when restored then 'capture_restored' end, case when onset_moved then 'onset_reconstructed' end, case when cleared_words>0 then 'unresolved_cleared' end, case when expansion_ms>0 then 'search_extended' end, case when boundary='validated_words' then 'boundary_derived' end], lambda x: x is not null),',') overrides from aud),
z1 as (select *, case when override then 'MANUALLY_OVERRIDDEN' when tm is not null then 'UNRESOLVED_TIMING' when sp is not null then 'UNRESOLVED_SPEAKER' when is_music then 'VALIDATED' when overrides<>'' then 'VALIDATED_WITH_OVERRIDE' else 'VALIDATED' end state from z0),
states as (select *, tm is not null unresolved_timing, sp is not null unresolved_speaker, case when override then 'operator' when tm is not null then tm || case when conflict_ms>0 and tm<>'chronology' then '+chronology' else '' end when sp is not null then sp when is_music then 'no_dialogue' when overrides<>'' then 'overrides' else 'evidence' end cause from z1)"""



def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sentence(own: bool = False) -> str:
    """The sentence of a row's state, from the fixed texts; own: with those that a row
    brings along for a disputed speaker."""
    s, o = audit.SENTENCES, audit.OVERRIDES
    said = ", ".join((
        f"case when rejected then {_q(o['provider_timing_rejected'])} end", f"case when restored then {_q(o['capture_restored'])} end", f"case when onset_moved then {_q(o['onset_reconstructed'])} end", f"case when cleared_words>0 then cleared_words||{_q(o['unresolved_cleared'])} end",
        f"case when expansion_ms>0 then {_q(o['search_extended'][0])}||expansion_ms||{_q(o['search_extended'][1])} end", f"case when boundary='validated_words' then {_q(o['boundary_derived'])} end",
    ))
    plain = {"unmeasured_text", "collapse", "overlap", "chronology", "divergence"}
    timing = " ".join(f"when tm='{c}' then {_q(s[c])}" for c in sorted(plain)) + f" when tm='unplaced_words' then unresolved_words||{_q(s['unplaced_words'])} when tm='window_edge' then exhausted_words||{_q(s['window_edge'])} when tm='too_short' then near_zero_words||{_q(s['too_short'])}"
    late = f"case when conflict_ms>0 and tm<>'chronology' then {_q(audit.OUT_OF_ORDER[0])}||conflict_ms||{_q(audit.OUT_OF_ORDER[1])} else '' end"
    several, island = _q(s["several_speakers"]), _q(s["island"])
    if own:
        several = f"{_q(audit.SPAN_REASON[0])}||heard||{_q(audit.SPAN_REASON[1])}"
        island = f"{_q(islands.REASON[0])}||'Speaker '||(cast(regexp_extract(suggested,'[0-9]+$') as bigint)+1)||{_q(islands.REASON[1])}"
    return (
        f"case when override then {_q(s['operator'])} when tm is not null then (case {timing} end)||{late} when sp='no_turn' then {_q(s['no_turn'][0])}||uncovered_words||{_q(s['no_turn'][1])} when sp='several_speakers' then {several} when sp='island' then {island} "
        f"when is_music then {_q(s['no_dialogue'])} when overrides<>'' then 'Delivered with disclosed evidence-based overrides: '||array_to_string(list_filter([{said}], lambda x: x is not null),'; ')||'.' else {_q(s['evidence'])} end"
    )


_R = _W + _RULES + _DISPUTED + _FOLD + _REC
_A = _R + _ATTR
_B = _A + _BOUNDS
_I = _B + _ISLANDS
_D = _I + _AUDIT
_ROW = "programme_id, segment_id, group_no"
_LIST = "coalesce(array_to_string(list_sort(list({0}) filter ({1})),','),'')"

_KEYS = "array_to_string(list_slice(coalesce(list(segment_id||':'||word_index order by segment_id, word_index) filter ({0}),[]),1,200),',')"
_ZERO, _OKAY, _BAD = "'zero_width_final_window'", "'corroborated'", "'final_window_below_evidence_floor_uncorroborated'"

ORACLES = {
    "rec_reconciliation": _R + " select programme_id, segment_id, word_index, unresolved, reason, cleared, prior_reason from rec",
    "agg_06_word_report": _R + " select programme_id, count(*) filter (unresolved) unresolved_words, count(*) filter (cleared is not null) cleared_words, count(distinct case when cleared is not null then segment_id end) cleared_rows, count(*) filter (final='zero_width_final_window') zero_width_words, max(absorbed) worst_absorbed_ms from rec group by all",
    "agg_04_word_evidence": _R + ", k as (select *, row_number() over (partition by programme_id, segment_id order by word_index) n_ from rec where unresolved) select programme_id, segment_id, count(*) n, string_agg(concat_ws('|',word_index,text,ps,pe,s,e,reason),',' order by word_index) words from k where n_<=100 group by all",
    "agg_05_capture_report": _W + _RULES + _DISPUTED + _FOLD + " select programme_id, count(*) filter (outcome='restored') capture_restored_words, count(*) filter (outcome='provider_timing_rejected') provider_timing_rejected_words, count(*) filter (outcome='alignment_collapsed') alignment_collapse_words, count(*) filter (outcome='unresolved') unresolved_dispute_words, count(*) filter (outcome='alignment_collapsed') unrestorable_words, "
        + "coalesce(max(divergence) filter (outcome='restored'),0) worst_restored_divergence_ms, coalesce(max(divergence) filter (outcome='provider_timing_rejected'),0) worst_rejected_provider_divergence_ms, " + ", ".join(_KEYS.format(f"outcome='{o}'") + f" {n}" for o, n in (("restored", "restored_keys"), ("provider_timing_rejected", "rejected_keys"), ("alignment_collapsed", "collapsed_keys"), ("unresolved", "unresolved_dispute_keys"))) + " from arb group by programme_id",
    "agg_06_onset_report": _R + " select programme_id, count(*) filter (absorbed>0) onset_absorption_repairs, coalesce(max(absorbed) filter (absorbed>0),0) worst_onset_absorbed_ms, " + _KEYS.format("absorbed>0") + " repaired_keys from rec group by programme_id",
    "agg_06_acceptance_report": _R + " select programme_id, " + ", ".join(f"count(*) filter (final in ({x})) {n}" for n, x in (("zero_width_words", _ZERO), ("near_zero_words", f"{_OKAY},{_BAD}"), ("near_zero_corroborated_words", _OKAY), ("near_zero_unresolved_words", _BAD))) + ", " + ", ".join(_KEYS.format(f"final={x}") + f" {n}" for n, x in (("zero_width_keys", _ZERO), ("near_zero_unresolved_keys", _BAD), ("near_zero_corroborated_keys", _OKAY))) + " from rec group by programme_id",
    "agg_06_reconciliation_report": _R + " select programme_id, count(cleared) unresolved_cleared_words, count(distinct case when cleared is not null then segment_id end) unresolved_cleared_rows, count(*) filter (cleared='resolved_by_capture_restore') cleared_by_restore, count(*) filter (cleared='resolved_by_provider_corroboration') cleared_by_corroboration, " + _KEYS.format("cleared is not null") + " cleared_keys from rec group by programme_id",
    "fold_03_repairs": _D + """, cw as (select w.programme_id, w.segment_id, w.group_no, a.end_ms b, w.ps, w.pe, w.s, w.e, case when w.e>a.end_ms and w.s<a.end_ms then a.end_ms else w.e end e2 from aud a left join w6 w on w.programme_id=a.programme_id and w.segment_id=a.segment_id and w.group_no=a.group_no where a.repaired),
        cg as (select programme_id, segment_id, group_no, count(*) filter (e<>e2) clamped_words, max(greatest(abs(s-ps),abs(e2-pe))) shift from cw group by all)
        select a.programme_id, a.segment_id, a.group_no, a.end_ms, lpad((a.end_ms//3600000)::varchar,2,'0')||':'||lpad((a.end_ms//60000%60)::varchar,2,'0')||':'||lpad((a.end_ms//1000%60)::varchar,2,'0')||';'||lpad((a.end_ms%1000//40)::varchar,2,'0') tc_out, coalesce(clamped_words,0) clamped_words, coalesce(shift,0) max_provider_shift_ms
        from aud a left join cg on cg.programme_id=a.programme_id and cg.segment_id=a.segment_id and cg.group_no=a.group_no where a.repaired""",
    "agg_07_run_report": _D + """, hh as (select programme_id, count(*) filter (repaired) rp, count(*) filter (not repaired) df, max(overlap_ms) wo from hits group by all),
        gg as (select programme_id, count(*) filter (divergence_ms>1500) provider_capture_defects, count(*) filter (col) alignment_collapse_defects, count(*) filter (onset_moved) onset_reconstructed_rows, count(*) filter (restored) capture_restored_rows, count(*) filter (rejected) provider_timing_rejected_rows,
        coalesce(max(divergence_ms) filter (divergence_ms>1500),0) worst_provider_divergence_ms, max(inflation_ms) worst_acoustic_inflation_ms, count(*) filter (inflation_ms>1500) inflated_row_count, count(*) filter (conflict_ms>0) chronology_conflict_rows, max(conflict_ms) worst_chronology_inversion_ms,
        array_to_string(list_slice(coalesce(list(sequence_index order by sequence_index) filter (conflict_ms>0),[]),1,500),',') chronology_conflict_sequences, array_to_string(coalesce(list(sequence_index order by sequence_index) filter (defect is not null),[]),',') defect_sequences from aud group by programme_id),
        ww as (select programme_id, count(*) filter (outcome='restored') capture_restored_words, count(*) filter (outcome='provider_timing_rejected') provider_timing_rejected_words, count(*) filter (outcome='alignment_collapsed') alignment_collapse_words, count(*) filter (outcome='alignment_collapsed') unrestorable_capture_words, count(*) filter (outcome='unresolved') unresolved_dispute_words,
        coalesce(max(divergence) filter (outcome='restored'),0) worst_restored_divergence_ms, coalesce(max(divergence) filter (outcome='provider_timing_rejected'),0) worst_rejected_provider_divergence_ms, count(*) filter (absorbed>0) onset_absorption_repairs, coalesce(max(absorbed) filter (absorbed>0),0) worst_onset_absorbed_ms,
        """ + ", ".join(f"count(*) filter (final in ({x})) {n}" for n, x in (("zero_width_words", _ZERO), ("near_zero_words", f"{_OKAY},{_BAD}"), ("near_zero_corroborated_words", _OKAY), ("near_zero_unresolved_words", _BAD))) + """, count(cleared) unresolved_cleared_words, count(distinct case when cleared is not null then segment_id end) unresolved_cleared_rows from rec group by programme_id)
        select gg.*, ww.* exclude (programme_id), coalesce(rp,0) same_speaker_overlap_repairs, coalesce(df,0) same_speaker_overlap_defects, coalesce(wo,0) worst_same_speaker_overlap_ms, 9 policy_version, 250 auto_repair_ceiling_ms, 1500 provider_divergence_threshold_ms, 40 min_plausible_word_ms from gg left join hh on hh.programme_id=gg.programme_id left join ww on ww.programme_id=gg.programme_id""",
    "pipe_02_attribution": _A + f" select {_ROW}, sequence_index, cluster, speaker_index, start_ms, end_ms, core_start, core_end, pb_start, pb_end, n_words, span_unresolved, authored_preserved, is_music, text from rows_",
    "agg_03_row_rollups": _A + f" select {_ROW}, unresolved_words, exhausted_words, near_zero_words, cleared_words, uncovered_words, absorbed_ms, max_shift_ms, restored, rejected, collapsed, below_floor_words, restored_ms, rejected_ms, expansion_ms, alignment_pass, floor(mean_confidence*1e6+0.501)/1e6 mean_confidence from rows_",
    "agg_02_cluster_counts": _A + " select programme_id, cluster, count(*) n_rows from rows_ group by all",
    "pipe_03_boundaries_of_length": _A + _BOUNDS.replace("from rows_)", "from rows_ left join (select programme_id, max(e)+(programme_id*37)%300-50 dur from words where programme_id%5<>0 group by programme_id) using (programme_id))", 1).replace("when nx is null then 200.0", "when nx is null then coalesce(greatest(0.0,dur-core_end),200.0)")
        + f" select {_ROW}, start_ms, end_ms, boundary, lead_in_ms, lead_out_ms from bounds",
    "pipe_06_own_reasons": _D + _STATES + f", hd as (select programme_id, segment_id, group_no, count(distinct filled) heard from w6 group by all) select {_ROW}, state, cause, " + _sentence(True) + " state_reason from states left join hd using (programme_id, segment_id, group_no) where unresolved_speaker",
    "pipe_03_boundaries": _B + f" select {_ROW}, start_ms, end_ms, boundary, lead_in_ms, lead_out_ms, delta_start_ms, delta_end_ms, contradicted, recovered, conflict_ms from bounds",
    "agg_08_boundary_report": _B + """ select programme_id, count(*) filter (boundary='validated_words') validated_words, count(*) filter (boundary='validated_words_stable') validated_words_stable, count(*) filter (boundary='music_preserved') music_preserved, count(*) filter (boundary='authored_preserved') authored_preserved,
        count(*) filter (boundary='unresolved_words_preserved') unresolved_words_preserved, count(*) filter (recovered) recovered, count(*) filter (contradicted) contradicted, greatest(0,coalesce(max(end_ms-pb_end) filter (has_core),0)) worst_extension_ms, greatest(0,coalesce(max(pb_end-end_ms) filter (has_core),0)) worst_reduction_ms,
        greatest(0,coalesce(max(lead_out_ms) filter (has_core),0)) worst_lead_out_ms, count(*) filter (conflict_ms>0) conflict_rows, max(conflict_ms) worst_conflict_ms, """ + _LIST.format("sequence_index", "conflict_ms>0") + " conflict_sequences from bounds group by programme_id",
    "pipe_04_islands": _I + f" select {_ROW}, island, overlap_ms, suggested, signals from isl",
    "fold_03_overlaps": _D + " select * from hits",
    "pipe_05_audit": _D + f" select {_ROW}, end_ms, defect, defect_ms, repaired, inflation_ms, divergence_ms from aud",
    "agg_07_integrity": _D + """, hh as (select programme_id, count(*) filter (repaired) overlap_repairs, count(*) filter (not repaired) overlap_defects, max(overlap_ms) worst_overlap_ms from hits group by all),
        gg as (select programme_id, count(*) n_rows, count(*) filter (repaired) repaired_rows, count(*) filter (col) collapse_defects, count(*) filter (divergence_ms>1500) divergence_defects, max(inflation_ms) worst_inflation_ms, count(*) filter (inflation_ms>1500) inflated_rows, count(*) filter (onset_moved) onset_rows,
        count(*) filter (restored) restored_rows, count(*) filter (rejected) rejected_rows, count(*) filter (conflict_ms>0) conflict_rows, """ + _LIST.format("sequence_index", "defect is not null") + """ defect_sequences from aud group by programme_id)
        select g.*, coalesce(overlap_repairs,0) overlap_repairs, coalesce(overlap_defects,0) overlap_defects, coalesce(worst_overlap_ms,0) worst_overlap_ms from gg g left join hh h on g.programme_id=h.programme_id""",
    "pipe_06_states": _D + _STATES + f" select {_ROW}, state, cause, overrides, unresolved_timing, unresolved_speaker, " + _sentence() + " state_reason from states",
    "pipe_07_export_gate": _D + _STATES + " select programme_id, count(*) filter (state in ('UNRESOLVED_TIMING','UNRESOLVED_SPEAKER')) blocking, count(*) total, count(*) filter (state in ('UNRESOLVED_TIMING','UNRESOLVED_SPEAKER'))=0 exportable from states group by all",
    "agg_09_state_summary": _D + _STATES + " select programme_id, count(*) filter (state='VALIDATED') validated, count(*) filter (state='VALIDATED_WITH_OVERRIDE') validated_with_override, count(*) filter (state='UNRESOLVED_TIMING') unresolved_timing, count(*) filter (state='UNRESOLVED_SPEAKER') unresolved_speaker, count(*) filter (state='MANUALLY_OVERRIDDEN') manually_overridden, count(*) filter (state in ('UNRESOLVED_TIMING','UNRESOLVED_SPEAKER')) blocking, count(*) total from states group by all",
}
