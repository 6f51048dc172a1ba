"""Brute-force versions straight from the contracts."""
import collections
import hashlib
import re
BL=" \t\n\x0b\x0c\r"
def low(s): return "".join(chr(ord(c)+32) if "A"<=c<="Z" else c for c in s)
def op1(docs):
    keys=collections.defaultdict(set); out=[]
    for d,t in docs:
        for l in (t or "").split("\n"):
            k=low(l.strip(BL))
            if len(k)>=40 and d is not None: keys[k].add(d)
    gone={k:max(v) for k,v in keys.items() if len(v)>=5}
    for d,t in docs:
        ls=(t or "").split("\n"); kept=[l for l in ls if low(l.strip(BL)) not in gone or gone[low(l.strip(BL))]==d]
        out.append((d,len(ls),len(ls)-len(kept),hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out
def words3(t): return re.findall(r"[^\x20\x09-\x0D]+",low(t or ""))
def comps(n,edges):
    p=list(range(n))
    def f(x):
        while p[x]!=x: p[x]=p[p[x]]; x=p[x]
        return x
    for a,b in edges: p[f(a)]=f(b)
    return [f(x) for x in range(n)]
def op3(docs,W=4,P=85):
    S=[]
    for d,t in docs:
        w=words3(t); S.append(frozenset([tuple(w)]) if 0<len(w)<W else frozenset(tuple(w[i:i+W]) for i in range(len(w)-W+1)))
    inv=collections.defaultdict(list); edges=[]
    for i,s in enumerate(S):
        c=collections.Counter()
        for x in s: c.update(inv[x])
        for j,k in c.items():
            if 100*k>=P*(len(s)+len(S[j])-k): edges.append((i,j))
        for x in s: inv[x].append(i)
    r=comps(len(S),edges); m={}
    for i,(d,_) in enumerate(docs): 
        if d is not None: m[r[i]]=min(m.get(r[i],d),d)
    return [(d,len(S[i]),m.get(r[i])) for i,(d,_) in enumerate(docs)]
def op8(docs,items,W=10):
    R=re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    pats=collections.defaultdict(set)
    for i,t in items:
        w=tuple(R.findall(low(t or "")))
        if w and i is not None:
            for k in range(len(w)-min(W,len(w))+1): pats[w[k:k+min(W,len(w))]].add(i)
    lens=sorted({len(p) for p in pats}); out=[]
    for d,t in docs:
        w=tuple(R.findall(low(t or ""))); hit=set(); it=set()
        for n in lens:
            for k in range(len(w)-n+1):
                o=pats.get(w[k:k+n])
                if o: hit.update(range(k,k+n)); it|=o
        out.append((d,len(w),len(hit),len(it),hashlib.sha256(",".join(sorted(map(str,it))).encode()).hexdigest(),bool(hit)))
    return out
